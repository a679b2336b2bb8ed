"""Language profiles against plain dictionaries, and in any layout of the table."""

import random

import numpy as np
import pytest

from lorefield.llm import language

from . import edges


def plain_prediction(own, listed, text):
    """Out-of-place distance over dictionaries: the places of the text's listed n-grams against their places in each profile."""
    counts = language.gram_counts(text)
    if not counts:
        return language.UNKNOWN, 0.0
    place = {g: i for i, g in enumerate(listed)}
    seen = sorted((g for g in counts if g in place), key=lambda g: (-counts[g], place[g]))[:language.DOCUMENT_RANKS]
    if not seen:
        return own.languages[0], 0.0
    away = []
    for j in range(len(own.languages)):
        profile = {g: own.ranks[place[g], j] for g in seen if own.ranks[place[g], j] < language.LANGUAGE_RANKS}
        away.append(sum(abs(profile[g] - k) if g in profile else language.LANGUAGE_RANKS for k, g in enumerate(seen)))
    best = away.index(min(away))
    return own.languages[best], 1 - away[best] / (language.LANGUAGE_RANKS * len(seen))


@pytest.mark.parametrize("bits", [22, 4])
def test_distances_equal_plain_ones(monkeypatch, bits):
    monkeypatch.setattr(language, "TABLE_BITS", bits)
    rng = random.Random(3)
    texts = {"x": "the cat sat on the mat with that hat", "y": "die katze saß auf der matte mit dem hut", "z": "le chat était assis là où çà"}
    ranked = {k: [g for g, _ in sorted(language.gram_counts(t).items(), key=lambda i: (-i[1], i[0]))] for k, t in texts.items()}
    listed = sorted({g for r in ranked.values() for g in r})
    ranks = np.full((len(listed), 3), language.LANGUAGE_RANKS, np.int64)
    for j, r in enumerate(ranked.values()):
        for k, g in enumerate(r):
            ranks[listed.index(g), j] = k
    own = language.RankProfiles(tuple(ranked), listed, ranks)
    assert (own.sorted is None) == (bits == 22)
    words = " ".join(texts.values()).split() + ["Zug", "中文", "12", "--", "ß"]
    for text in [*texts.values(), "", "12 34", "中文"] + [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(150)]:
        got, want = own.predict(text), plain_prediction(own, listed, text)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-12, text


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [edges.rows_of(language.identify_language(d)) for d in (docs, docs.repartition(7, "lang"), docs.orderBy("text"))]
    assert rows[0] == rows[1] == rows[2]
    small = [sorted(language.train_profiles(d, sample=60).ranks.ravel().tolist()) for d in (docs, docs.repartition(5))]
    assert small[0] == small[1]
