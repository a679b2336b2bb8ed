"""Queries over the test tables, with the same query in SQL where SQL can say it."""

from workload.base import ORACLES, QUERIES
from workload import chunks, collections, models, similarity, states, text  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
