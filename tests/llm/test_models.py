"""Models against plain versions: slopes of the risk, all segmentations of a window, draws in any layout."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorefield.llm import pii, toxicity

from . import edges


@pytest.mark.parametrize("shift, negative", [(1.0, True), (-1.0, False)])
def test_risk_slope_is_the_numeric_one(shift, negative):
    rng = np.random.default_rng(5)
    pos, prior = np.arange(30) < 12, 0.45
    z = rng.normal(size=30) + np.where(pos, 2 * shift, -2 * shift)

    def plain(z):
        """Both parts of the risk, row by row."""
        loss = lambda s, sign: np.log1p(np.exp(-sign * s))
        gain = prior * sum(loss(s, 1) for s in z[pos]) / 12
        return gain, sum(loss(s, -1) for s in z[~pos]) / 18 - prior * sum(loss(s, -1) for s in z[pos]) / 12

    gain, part, slope = toxicity.risk_slope(z, pos, prior)
    assert np.allclose((gain, part), plain(z)) and (part < 0) == negative
    followed = (lambda z: -plain(z)[1]) if negative else (lambda z: sum(plain(z)))
    for k in range(30):
        step = np.zeros(30)
        step[k] = 1e-6
        assert np.isclose((followed(z + step) - followed(z - step)) / 2e-6, slope[k], atol=1e-7)


def segmentations(lat, at=0):
    """Every way through a lattice, as lists of segment numbers."""
    if at == lat.n:
        yield []
    for k, (i, j, *_) in enumerate(lat.segments):
        if i == at:
            for rest in segmentations(lat, j):
                yield [k, *rest]


def test_best_segmentation_of_all():
    rng = random.Random(8)
    words = ["joe", "(at)", "site", "dot", "com,", "call", "0049", "171", "2345678", "10[.]0[.]0[.]1", "a@b.org."]
    for trial in range(40):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))
        lat = pii.lattice(text, 0, len(text))
        weights = np.random.default_rng(trial).normal(size=pii.SLOTS)
        scores = weights[np.array(lat.slots)].sum(1)
        ways = list(segmentations(lat))
        totals = [scores[w].sum() for w in ways]
        best = ways[int(np.argmax(totals))]
        assert pii.SpanModel(weights).decode(lat) == [lat.segments[k][2:] for k in best if lat.segments[k][2]]
        up, _ = pii._sweep(lat, scores, total=True)
        assert np.isclose(up[-1], np.logaddexp.reduce(totals))


def test_models_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{edges.SF}/documents.parquet")
    labels = spark.read.parquet(f"{edges.SF}/labels.parquet")
    other = docs.repartition(7, F.col("text"))
    a, b = (toxicity.train_toxicity(d, labels, unlabelled=60) for d in (docs, other))
    assert a.bias == b.bias and (a.weights == b.weights).all()
    a, b = (pii.train_spans(d, sample_docs=40) for d in (docs, other))
    assert (a.weights == b.weights).all()
