"""Link masking in one pass against the masking by expressions."""

import random
import time

import pytest

from lorefield.functions import links


def rows(spark, texts, many, monkeypatch):
    monkeypatch.setattr(links, "MANY", many)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, md string")
    return {r.id: (r.masked, None if r.link_map is None else [(e.key, e.value) for e in r.link_map]) for r in links.mask_links(df, "md").collect()}


def test_both_ways_mask_alike(spark, monkeypatch):
    rng = random.Random(7)
    parts = ["[a](x)", "[a](y)", "[b]()", "![p](u)", "![p](v)", "![](w)", "[[n](z)](q)", "[![i](s)](t)", "text ", "\n", "<a>", "<img1>", "](", "[", "!", "é日", "[a2](k)", "[x\ny](m)", "[a](x)[a](x)"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(300)] + [None, "", "no links", "\u2028[a\u2028b](c)", "[a](b\r\nc)"]
    assert rows(spark, texts, -1, monkeypatch) == rows(spark, texts, 10 ** 6, monkeypatch)


def test_many_links_cost_a_pass(spark):
    text = " ".join(f"[label {i % 900}](http://a.example/{i}) and ![p](u{i})" for i in range(50_000))
    start = time.perf_counter()
    found = links._mask_text(text)
    assert time.perf_counter() - start < 3
    assert len(found["link_map"]) > 90_000 and found["masked"].startswith("<label 0> and <img1> <label 1> and <img2>")
    df = spark.createDataFrame([(1, text), (2, "[a](b)"), (3, None)], "id int, md string")
    start = time.perf_counter()
    got = {r.id: r for r in links.mask_links(df, "md").collect()}
    assert time.perf_counter() - start < 30
    assert got[1].masked == found["masked"] and got[2].masked == "<a>" and got[3].masked is None


@pytest.mark.parametrize("n", [256, 257])
def test_the_number_of_links_changes_nothing(spark, n):
    text = "".join(f"[l{i % 3}](t{i})" for i in range(n))
    df = spark.createDataFrame([(text,)], "md string")
    row = links.mask_links(df, "md").first()
    assert row.masked == links._mask_text(text)["masked"] and len(row.link_map) == n
