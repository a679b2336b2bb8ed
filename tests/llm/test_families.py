"""Large families of near copies, and token ids put together from remembered pieces."""

import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lorefield.llm import packing, simhash
from lorefield.llm.common import stored

from .test_brute import groups, shingles

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def family(rng, size, length, most):
    """Copies of one text with up to ``most`` words replaced, cut off or added."""
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(length)]
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        yield " ".join(words[rng.choice([0, 0, 3]):len(words) - rng.choice([0, 0, 9])])


def similar_pairs(sets, similar=0.8):
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for h in holders.values():
        for k, a in enumerate(h):
            for b in h[k + 1:]:
                shared[a, b] += 1
    return {p for p, n in shared.items() if n >= similar * (len(sets[p[0]]) + len(sets[p[1]]) - n)}


def test_families_of_mixed_sizes(spark):
    rng = random.Random(21)
    texts = [t for size, length, most in ((500, 150, 9), (300, 90, 7), (150, 400, 30), (40, 60, 3), (12, 2000, 90)) for t in family(rng, size, length, most)]
    rng.shuffle(texts)
    texts = dict(enumerate(texts))
    sets = {i: set(shingles(t, 5)) for i, t in texts.items()}
    links = similar_pairs(sets)
    want = set(groups(texts, links).values())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id for r in simhash.drop_near_duplicates(docs).select("doc_id").collect()}
    # No group loses all its texts, and at least 0.99 of the texts that go are found.
    assert want <= got and len(got - want) <= 0.01 * (len(texts) - len(want))
    assert len(want) > 100


@pytest.mark.parametrize("block, carried", [(512, 128), (7, 128), (5, 2), (1, 0)])
def test_prefix_lists_hold_every_similar_pair(spark, monkeypatch, block, carried):
    monkeypatch.setattr(simhash, "LIST", block)
    monkeypatch.setattr(simhash, "CARRIED", carried)
    rng = random.Random(5)
    sets = {}
    for k in range(6):
        base = rng.sample(range(60 * k, 60 * k + 70), 30)
        for _ in range(25):
            own = set(rng.sample(base, rng.randint(22, 30))) | set(rng.sample(range(10_000), rng.randint(0, 3)))
            sets[len(sets)] = own
    sets |= {len(sets) + i: {20_000 + i} for i in range(3)} | {900: {1}, 901: {1}}
    roots = {i: 0 if i in (3, 4, 5, 30) else i for i in sets}
    want = {p for p in similar_pairs(sets) if roots[p[0]] != roots[p[1]]}
    table = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "key long, shingles array<int>")
    named = spark.createDataFrame(list(roots.items()), "key long, root long")
    got = [tuple(r) for r in simhash._prefix_pairs(table, named, 0.8).collect()]
    assert len(got) == len(set(got)) and all(a < b and roots[a] != roots[b] for a, b in got)
    assert want <= set(got) and len(want) > 100


def test_remembered_pieces_give_the_ids_of_the_default_tokenizer(monkeypatch):
    rng = random.Random(2)
    latin = "".join(map(chr, range(256)))
    texts = [latin, *latin, *(f"a{c}b" for c in latin), *(f"1{c}2" for c in latin), "x" * 5000 + " " + "é" * 5000, "Ａ ﬁne İstanbul ΣΑΣ é 日本 ½"]
    texts += ["".join(rng.choices(pool, k=rng.randint(0, 60))) for pool in (latin, "ab 'stremvld.,!19\n\tÀß²½\xa0\x85ªºµ×÷éİœ日") for _ in range(3000)]
    want = Tokenizer.from_file(TOKENIZER)
    for most in (packing.PIECES_KEPT, 20):
        monkeypatch.setattr(packing, "PIECES_KEPT", most)
        words = packing.WordTokens(TOKENIZER)
        for t in texts:
            assert words.ids(t) == np.array(want.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    assert len(words.known) + len(words.known.before) < 3000


def test_old_pieces_that_are_used_again_stay():
    made = []
    pieces = packing.Pieces(lambda p: made.append(p) or p.encode(), 3)
    for text in ("abcd", "ae", "af", "ghij", "a"):
        pieces.age()
        assert b"".join(map(pieces.__getitem__, text)) == text.encode()
    assert made == list("abcdefghij") and pieces.before.keys() == set("aefghij")


def test_pieces_are_those_of_the_tokenizers_rule():
    assert packing.is_latin("") and packing.is_latin("aÿ\xa0") and not packing.is_latin("aĀ")
    rule = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
    rng = random.Random(8)
    for _ in range(5000):
        t = "".join(rng.choices(" ''stremvldlaé1²!,.\xa0", k=40))
        assert packing.PIECE.findall(t) == rule.findall(t)


def test_packing_of_all_tables_keeps_the_default_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = Tokenizer.from_file(TOKENIZER)
    lengths = {r.doc_id: r.n for r in packing.pack_documents(docs, TOKENIZER).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    rows = docs.select("doc_id", "text").collect()
    ids = own.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    assert lengths == {r.doc_id: len(e.ids) + 1 for r, e in zip(rows, ids)}


def test_posting_lists_are_sent_by_their_count_only(spark, monkeypatch):
    fps = np.random.default_rng(11).integers(-2**63, 2**63, 200)
    table = stored(spark.createDataFrame([(int(v),) for v in np.concatenate([fps, fps ^ 1])], "fp bigint"), "fps")
    sent = lambda links: "BroadcastExchange" in links._jdf.queryExecution().executedPlan().toString()
    few = simhash.fingerprint_links(table)
    assert sent(few) and few.count() == 200
    # Lists that are too many as counted, though the table before the explode is small.
    monkeypatch.setattr(simhash, "LIST_BYTES", 1 << 20, raising=False)
    many = simhash.fingerprint_links(table)
    assert not sent(many) and {tuple(r) for r in many.collect()} == {tuple(r) for r in few.collect()}
