"""Operators against brute force over the smallest tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lorefield.llm import (decontaminate, extraction, fingerprints, language, packing, pii, queries, simhash, substrings, toxicity)
from lorefield.llm.components import connected_components

from . import edges

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def table(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{edges.SF}/documents.parquet").collect()}


def run(spark, name):
    return queries.QUERIES[name](spark, edges.SF)


def shingles(text, words):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return [b" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []


def groups(nodes, linked):
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    random.seed(5)
    pairs = [(random.randint(1, 400), random.randint(1, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    links = spark.createDataFrame(pairs + [(None, 3)], "a long, b long")
    real = [p for p in pairs if p[0] != p[1]]
    want = groups({n for p in real for n in p}, real)
    assert {r.node: r.root for r in connected_components(links).collect()} == want


def test_simhash(spark, table):
    want = {}
    for i, t in table.items():
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles(t, 3)]
        want[i] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    ids = sorted(want)
    near = [(a, b) for a in ids for b in ids if a < b and (want[a] ^ want[b]).bit_count() <= 2]
    root = groups(ids, near)
    assert {tuple(r) for r in run(spark, "op9_simhash").collect()} == {(i, f"{want[i]:016x}", root[i]) for i in ids}


def test_near_fingerprints_in_one_list():
    random.seed(2)
    base = random.getrandbits(64)
    values = sorted({base ^ sum(1 << b for b in random.sample(range(8, 24), random.randint(0, 5))) for _ in range(300)})
    found = groups(values, simhash._near(values, 2))
    assert found == groups(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2])


def test_near_duplicates(spark, table):
    random.seed(8)
    words = [f"w{i}" for i in range(900)]
    texts = dict(table)
    for k in range(120):  # copies at many similarities
        own = random.choices(words, k=random.randint(40, 300))
        texts[10_000 + 10 * k] = " ".join(own)
        for j in range(1, 4):
            new = [random.choice(words) if random.random() < 0.012 * j else w for w in own]
            texts[10_000 + 10 * k + j] = " ".join(new)
    sets = {i: set(shingles(t, 5)) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for h in holders.values() for a in h for b in h if a < b)
    links = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    want = set(groups(texts, links).values())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    # A pair is found with probability 0.998 or more.
    assert want <= got and len(got - want) <= 2


def test_similar_pairs_in_a_large_family(spark):
    random.seed(12)
    passage = [f"p{i}" for i in range(300)]
    own = lambda n: [f"w{random.randrange(10 ** 7)}" for _ in range(n)]
    texts = [passage + own(45) for _ in range(2500)]
    for k in range(60):  # partners within the family
        texts[2 * k + 1] = passage + texts[2 * k][300:320] + own(25)
    sets = [set(shingles(" ".join(t), 5)) for t in texts]
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(0.83 < like(2 * k, 2 * k + 1) < 0.87 for k in range(60))
    assert all(0.73 < like(k, k + 777) < 0.77 for k in range(300, 1700))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id for r in simhash.drop_near_duplicates(docs).select("doc_id").collect()}
    assert got == set(range(2500)) - {2 * k + 1 for k in range(60)}


def test_decontamination(spark, table):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{edges.SF}/benchmark.parquet").collect()}

    def tokens(text):
        return [w for w in re.split(r"[^\w]+|_", text.lower()) if w]

    random.seed(4)
    texts = dict(table)
    for k, (i, t) in enumerate(items.items()):  # passages with a word in nine replaced
        w = t.split(" ")
        texts[50_000 + k] = "some words before " + " ".join("x" if j % 9 == 4 else x for j, x in enumerate(w)) + " and some after"
    want = set()
    for d, t in texts.items():
        w = tokens(t)
        own = defaultdict(list)
        for i, x in enumerate(w):
            own[x].append(i)
        for n, text in items.items():
            v = tokens(text)
            equal = Counter(i - j for j, x in enumerate(v) for i in own.get(x, []))
            # Every diagonal with enough equal words for the score, whether a seed lies on it or not.
            shifts = [s for s, c in equal.items() if 2 * c >= min(2 * decontaminate.SCORE, len(v))]
            for s in shifts:
                best = here = 0
                for j, x in enumerate(v):
                    here = max(0, here) + (1 if 0 <= j + s < len(w) and w[j + s] == x else decontaminate.MISMATCH)
                    best = max(best, here)
                if 2 * best >= min(2 * decontaminate.SCORE, len(v)):
                    want.add((d, n))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 0):  # both ways of joining
        found = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_overlaps(docs, bench, broadcast_bytes=limit).collect()}
        assert found == want
    assert {50_000 + k for k in range(len(items))} <= {d for d, _ in want}


def test_decontamination_against_every_diagonal(spark):
    random.seed(14)
    items = {n: [f"v{random.randrange(10 ** 6)}" for _ in range(n)] for n in (10, 11, 15, 16, 20, 37, 60)}
    texts, at = {}, 0
    for v in items.values():
        drawn = [{j for j in range(len(v)) if j % every == phase} for every in range(3, 10) for phase in range(every)]
        drawn += [{j for j in range(len(v)) if random.random() < share} for share in (0.1, 0.2, 0.25, 0.3) for _ in range(25)]
        drawn += [{j for j in range(len(v)) if j % 7 in (3, 6)}, {j for j in range(len(v)) if j % 10 in (3, 6, 9)}]  # runs of 3, 2 and 3, 2, 2
        for gone in drawn:
            texts[at], at = ["some", "words"] + [f"x{j}" if j in gone else x for j, x in enumerate(v)] + ["after"], at + 1
    want = {}
    for d, w in texts.items():
        for n, v in items.items():
            top = 0
            for s in range(-len(v) + 1, len(w)):
                here = 0
                for j, x in enumerate(v):
                    here = max(0, here) + (1 if 0 <= j + s < len(w) and w[j + s] == x else decontaminate.MISMATCH)
                    top = max(top, here)
            if 2 * top >= min(2 * decontaminate.SCORE, n):
                want[d, n] = top
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(v)) for n, v in items.items()], "item_id long, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        found = decontaminate.benchmark_overlaps(docs, bench, broadcast_bytes=limit).collect()
        assert {(r.doc_id, r.item_id): r.score for r in found} == want


def test_exact_copies_of_short_items(spark):
    texts = {1: "Say: what is it? Nothing", 2: "what is that it", 3: "one", 4: "a b c d e f g h i", 5: "a b c d x f g h i", 6: None, 7: "what is it",
             8: "it what is it what is it"}
    items = {1: "What is it", 2: "a b c d e f g h i", 3: "One!", 4: "", 5: None, 6: "is it nothing more"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        found = decontaminate.benchmark_overlaps(docs, bench, broadcast_bytes=limit).collect()
        assert sorted((r.doc_id, r.item_id, r.score, r.doc_first) for r in found) == [(1, 1, 3, 1), (3, 3, 1, 0), (4, 2, 9, 0), (7, 1, 3, 0), (8, 1, 3, 1)]


def test_substrings(spark, table):
    data = {i: t.encode() for i, t in table.items()}
    seen = Counter(t[i:i + 200] for t in data.values() for i in range(len(t) - 199))
    want = set()
    for i, t in data.items():
        spans = substrings.merged([(k, k + 200) for k in range(len(t) - 199) if seen[t[k:k + 200]] > 1])
        rest, at = b"", 0
        for a, b in spans:
            rest, at = rest + t[at:a], b
        rest += t[at:]
        want.add((i, len(t), len(t) - len(rest), len(spans), hashlib.sha256(rest).hexdigest()))
    docs = spark.read.parquet(f"{edges.SF}/documents.parquet")
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {tuple(r) for r in run(spark, "op6_substrings").select(columns).collect()} == want
    assert {tuple(r) for r in substrings.remove_repeats(docs, together=3).select(columns).collect()} == want  # split groups


def test_substrings_of_repetitive_texts(spark):
    random.seed(3)
    w = ["".join(random.choices("abcdef ", k=random.randint(20, 400))) for _ in range(12)]
    texts = ["".join(random.choices(w, k=random.randint(0, 6))) for _ in range(40)] + ["a" * 5000, "ab" * 300, "a" * 230 + "b" * 230, "x" * 199, "x" * 200]
    seen = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    want = {i: sum(b - a for a, b in substrings.merged([(k, k + 200) for k in range(len(t) - 199) if seen[t[k:k + 200]] > 1]))
            for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for together in (substrings.TOGETHER, 2):
        assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs, together).collect()} == want


def test_fingerprints(spark, table):
    ids = sorted(table, reverse=True)
    got = {r.doc_id: r for r in run(spark, "op1_fingerprints").collect()}
    assert len(got) == len(ids)

    def items(text):
        return set(fingerprints.digests(text).tolist())

    def like(a, b):
        return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0

    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        t, n = table[i], table[nxt]
        cut = len(t) // 3
        new = t[:len(t) - cut] + n[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert abs(r.near_edited - like(items(t), items(new))) < 1e-9 and abs(r.near_next - like(items(t), items(n))) < 1e-9
    by_text = defaultdict(set)
    for i in ids:
        by_text[table[i]].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_difference_recovers_digests():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (0, 1, 40, 900)]
    for a in sets:
        for b in sets:
            mine, theirs = np.append(a, sets[3][:300]), np.append(b, sets[3][:300])
            mine, theirs = np.unique(mine), np.unique(theirs)
            (left, right), = fingerprints.differences([mine], [theirs])
            assert set(left) == set(mine.tolist()) - set(theirs.tolist()) and set(right) == set(theirs.tolist()) - set(mine.tolist())


def best_fit(lengths, capacity):
    import bisect

    spare = []
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(spare, n)
        bisect.insort(spare, (spare.pop(k) if k < len(spare) else capacity) - n)
    return spare


def test_packing(spark, table):
    own = Tokenizer.from_file(TOKENIZER)
    rows = run(spark, "op5_packing").collect()
    pieces = defaultdict(dict)
    for r in rows:
        pieces[r.doc_id][r.piece] = r
    lengths = []
    for i, t in table.items():
        ids = own.encode(t, add_special_tokens=False).ids + [0]
        parts = [ids[k:k + 2048] for k in range(0, len(ids), 2048)]
        assert len(parts) == len(pieces[i])
        for k, part in enumerate(parts):
            r = pieces[i][k]
            assert (r.start, r.length, r.ids_crc32) == (2048 * k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            lengths.append(len(part))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own_pieces in bins.values():
        at = 0
        for offset, n in sorted(own_pieces):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(bins) == len(best_fit(lengths, 2048))


def test_plan_is_best_fit_decreasing():
    random.seed(1)
    for _ in range(120):
        capacity = random.choice([10, 64, 2048])
        lengths = [random.randint(1, capacity if random.random() < 0.7 else max(1, capacity // 6)) for _ in range(random.randint(0, 300))]
        counts = Counter(lengths)
        runs = packing.plan_packing(counts, capacity)
        used = defaultdict(int)
        for n, c in counts.items():
            own = [r for r in runs if r[0] == n]
            for rank in range(c):
                _, first_rank, first_bin, _ = max((r for r in own if r[1] <= rank), key=lambda r: r[1])
                used[first_bin + rank - first_rank] += n
        assert sorted(capacity - x for x in used.values()) == best_fit(lengths, capacity)


def test_word_tokens_equal_whole_texts():
    words = packing.WordTokens(TOKENIZER)
    for t in ["Hello, World. it's  I'll. Été ΣΑΣ. x\x1cy <|endoftext|> a.. b... 12.5, don't.  z İstanbul é.", "", "   ", ".", ",a", "'s. 's, O'Re."]:
        assert words.ids(t) == words.whole(t)


def test_special_tokens_in_texts_keep_their_ids():
    words, own = packing.WordTokens(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for t in ["text <|endoftext|> more", "<|startoftext|>a<|endoftext|>b", "a <|ENDOFTEXT|> b", "x<|endoftext|>. y", "no <|end of|> token", "<|endoftext|>"]:
        want = np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.ids("text more") + words.ids(t) == words.ids("text more") + want, t


def test_language(spark):
    got = run(spark, "op4_language").join(spark.read.parquet(f"{edges.SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_rank_profile_counts():
    listed = sorted({"a", "é", " a", "a ", "ab", "b", " ab ", "abcab", "ß"})
    own = language.RankProfiles(("x",), listed, np.zeros((len(listed), 1), np.int64))
    for t in ("ab é abcab, ABCAB! ab1ab", "", "12", "中文 a", "ßab_ab"):
        want = language.gram_counts(t)
        counts = own.counts(t)
        assert (counts is None) == (not want)
        assert counts is None or [int(c) for c in counts] == [want.get(g, 0) for g in listed]


def test_toxicity_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)

    def text(bad):
        words = [f"w{n}" for n in rng.integers(0, 400, 60)]
        return " ".join(words + ([f"nasty{rng.integers(9)}"] * 2 if bad else []))

    known = {}
    truth = rng.random(3000) < 0.1
    unlabelled = [toxicity.features(text(b), known) for b in truth]
    positive = [toxicity.features(text(True), known) for _ in range(300)]
    model = toxicity.fit_nnpu(positive, unlabelled, 0.1)
    fresh = [True] * 100 + [False] * 900
    scores = model.score([text(b) for b in fresh], known)
    assert np.mean([(s >= 0.7) == b for s, b in zip(scores, fresh)]) > 0.97


def test_toxicity_query(spark):
    rows = run(spark, "op7_toxicity").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or pii.luhn(digits)):
                out.append((kind, *m.span()))
    return out


def test_pii(spark, table):
    got = {r.doc_id: r for r in run(spark, "op10_pii").collect()}
    for i, t in table.items():
        want = plain_spans(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in want) for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(r.spans.split(",")) or not want


def test_base_patterns_on_odd_texts():
    random.seed(6)
    odd = ["a@b@c.d.e x@y.z@w.v .@.a.b 1.2.3.4.5.6.7.8 300.1.1.1 +1 (2) 3-4 5678 99+1 234 5678", "", "@", "1" * 3000, "+1" + " " * 500,
           "0004.1.1.255 4111-1111 1111-1111 0"]
    odd += ["".join(random.choices("a1@.+- ()", k=60)) for _ in range(3000)]
    for t in odd:
        assert pii.base_spans(t) == plain_spans(t), t


def test_written_out_data_is_found(table):
    examples = [e for t in table.values() for e in pii._examples(t)]
    texts = [f"word{i} mail to user{i}@mail{i % 7}.example.com for more words" for i in range(80)]
    texts += [f"call +1 ({200 + i}) 555-{1000 + i} or not, from {i}.{i}.7.{i} it came" for i in range(80)]
    model = pii.fit_spans(examples + [e for t in texts for e in pii._examples(t)])
    text = "write john.doe (at) mail dot example dot com or call 0044 20 7946 0958 from 10[.]0[.]0[.]7 today"
    found = {(k, text[a:b]) for k, a, b in model.spans(text, pii.base_spans(text))}
    assert ("email", "john.doe (at) mail dot example dot com") in found and ("ip", "10[.]0[.]0[.]7") in found
    plain = "order 1234567 was placed at dot plaza at noon"
    assert model.spans(plain, []) == []


def test_every_rewritten_form_is_a_candidate_and_found(table):
    texts = [f"word{i} mail to user{i}@mail{i % 7}.example.com for more words" for i in range(80)]
    texts += [f"call +1 ({200 + i}) 555-{1000 + i} or not, from {i}.{i}.7.{i} it came" for i in range(80)]
    texts += [f"card 4111 1111 1111 1111 of {w}" for w in ("mine", "yours", "theirs")]
    model = pii.fit_spans([e for t in [*table.values(), *texts] for e in pii._examples(t)])
    own = [("email", "jane.doe@example.com"), ("email", "jane.doe@mail.example.com"), ("ip", "10.20.30.40"),
           ("card", "4111 1111 1111 1111"), ("phone", "+1 (212) 555-0100")]
    for kind, span in own:
        for new in pii.rewritten(kind, span):
            text = f"write to {new} for more"
            place = (kind, 9, 9 + len(new))
            assert place in {s[2:] for s in pii.lattice(text, 0, len(text)).segments}, new
            assert place in model.spans(text, pii.base_spans(text)), new
    for new in ("jane.doe (at) example.com", "jane.doe [at] example.com", "jane.doe (AT) example.com"):  # no digit, @ or dot
        assert pii.masked(f"write to {new} for more", model.spans(f"write to {new} for more", [])) == "write to [EMAIL] for more"
    plain = "we met (at) noon, or [at] the latest at one"
    assert model.spans(plain, []) == []


def test_minimum_cut_is_minimal():
    random.seed(7)
    for _ in range(150):
        n = random.randint(0, 8)
        source, sink = ([random.choice([0, random.randint(0, 9)]) for _ in range(n)] for _ in "ab")
        edges_ = [(i, j, random.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if random.random() < 0.5]

        def cost(side):
            return (sum(s for s, k in zip(source, side) if not k) + sum(t for t, k in zip(sink, side) if k)
                    + sum(c for i, j, c in edges_ if side[i] != side[j]))

        best = min(cost([bits >> i & 1 for i in range(n)]) for bits in range(1 << n))
        assert cost(extraction.source_side(n, source, sink, edges_)) == best


def test_extraction(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{edges.SF}/pages.parquet").collect()}
    for r in run(spark, "op3_extraction").collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", p))).strip() for p in re.split(r"</?(?:h1|p|ul|li)[^>]*>", article))
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_extraction_of_a_mixed_page():
    page = """<html><head><title>t</title></head><body><header><a href=x>Home</a> <h2>Site name</h2></header>
<div class="cookie-notice">We use cookies. Please accept all of them now, thank you very much.</div><nav>Menu <a>A</a></nav>
<div id="content"><div class="post"><header><h1>Big title</h1><p class="byline">By me</p></header>
<p>First para &amp; more text here for all.</p><p>Ok.</p><form><label>Name</label><input></form>
<aside>See also this long thing that is related to it.</aside><ul><li>one<li>two</ul></div>
<div class="comments"><h3>Comments</h3><p>What a lovely article, I enjoyed reading it a lot, thanks.</p></div></div>
<div class=sidebar><p>Long text in sidebar with many words to read and see.</p></div><footer>(c) foo</footer></body>"""
    assert extraction.main_text(page) == "Big title\n\nBy me\n\nFirst para & more text here for all.\n\nOk.\n\none\n\ntwo"
