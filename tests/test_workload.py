"""Registered queries against their SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_workers_need_no_installed_package(tmp_path):
    """The entry works in a session whose workers cannot import this repository."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {root!r})\nimport __spark_entry__ as e\nfrom pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('rows', e.entry(s).count() > 0, e.queries()['chunk_documents'](s, {SF!r}).count() > 0)\n")
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows True True" in out.stdout, out.stderr[-2000:]
