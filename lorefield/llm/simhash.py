"""SimHash near-duplicates through an inverted index over byte positions.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in
at most two bits share at least six of the eight (position, byte) pairs, so the
guaranteed minimum is six. The index is posted under every choice of six
positions with their bytes: a pair meets in a posting list exactly when its
tally of shared positional bytes reaches the minimum, and a posting list can
never hold more than 65,536 different fingerprints, because only two bytes are
free in it. Inside a list, neighbours at two bits or fewer are linked through
shared one-bit variants, so no list is expanded into pairs.
"""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lorefield.llm.common import batch_rows, same, sent_if_small, stored
from lorefield.llm.components import connected_components

POSITIONS = 8
BITS_APART = 2
SEED = 42
LIST_BYTES = 64  # a row of a posting list's key, as broadcast


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every ``words``-word shingle, repeats included; a shorter text is one shingle."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) < words:
        return np.array([digest(joined, SEED)], np.uint64)
    starts = [0, *accumulate(len(p) + 1 for p in parts)]
    return np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[words:])), np.uint64,
                       len(parts) - words + 1)


def simhash(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """The bits that are set in over half of the hashes, as an unsigned number."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), block):
        ones += np.unpackbits(hashes[i:i + block].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fp`` (signed 64 bits) of every row; null texts count as empty and give 0."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([simhash(shingle_hashes(t or "", words)) for t in batch_rows(b, "text")[0]], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(hashed, f"doc_id {kind}, fp bigint")


def _masks(shared: int) -> list[int]:
    keep = [sum(0xFF << 8 * p for p in choice) for choice in combinations(range(POSITIONS), shared)]
    return [m - (1 << 64) if m >> 63 else m for m in keep]


def _near(values: list[int], apart: int) -> Iterator[tuple[int, int]]:
    """Links from each fingerprint to the least one of its chain; all values differ in two bytes at most.

    Two values at ``apart`` = 2 share a variant with one bit flipped.
    """
    top = {v: v for v in values}

    def root(v):
        while top[v] != v:
            top[v] = v = top[top[v]]
        return v

    free = 0
    for v in values:
        free |= v ^ values[0]
    flips = [0] + ([1 << i for i in range(64) if free >> i & 1] if apart == 2 else [])
    seen = {}
    for v in values:
        for f in flips:
            a, b = root(seen.setdefault(v ^ f, v)), root(v)
            if a != b:
                top[max(a, b)] = min(a, b)
    return ((v, root(v)) for v in values if root(v) != v)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join all fingerprints of ``fps(fp)`` at two or fewer differing bits."""
    shared = POSITIONS - BITS_APART
    posts = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
                      for i, m in enumerate(_masks(shared))])
    index = fps.select("fp", F.explode(posts).alias("post")).select("fp", "post.*")
    busy = stored(index.groupBy("choice", "bytes").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
                  .where("low < high").select("choice", "bytes"), "simhash-lists")
    # Spark sizes the postings as the table before the explode: never broadcast, while the lists are by their count.
    lists = (index.hint("merge").join(sent_if_small(busy, LIST_BYTES), ["choice", "bytes"]).groupBy("choice", "bytes")
             .agg(F.collect_set("fp").alias("members")).select("members"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [p for members in batch_rows(b, "members")[0]
                     for p in _near(sorted(int(m) & (1 << 64) - 1 for m in members), BITS_APART)]
            flat = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["a", "b"])

    return lists.mapInArrow(linked, "a bigint, b bigint").distinct()


def simhash_components(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Fingerprints link at two or fewer differing bits, equal ones always; the
    component is the smallest ``doc_id`` reachable. Null and empty texts share
    fingerprint zero. A null ``doc_id`` keeps its row and never names a
    component of other rows. Repeated rows give repeated rows, other columns are
    ignored, an empty table gives an empty table.
    """
    rows = stored(fingerprints(docs, words), "simhash")
    least = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = connected_components(fingerprint_links(least.select("fp")))
    placed = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # Stored, so that the join below is one that Spark can split where a component is large.
    names = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = placed.join(names, "root").select(F.col("fp").alias("known"), "component_id")
    return rows.join(named, rows.fp == named.known).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near-duplicate removal at a similarity of whole shingle sets. A pair at Jaccard similarity 0.8 differs in about ten
# of 64 majority bits, so none of eight bytes is sure to agree. The removal therefore fingerprints with sampled
# positions: byte j comes from the shingle that is least under the j-th permutation, and two documents share it with
# the probability of their similarity. Index, tally and verification are as above.

SAMPLED = 48
GROUP = 4  # positions posted together: 32 bits
LISTS = SAMPLED // GROUP
#: Shared positional bytes of 48: 38 are expected at similarity 0.8, this is nearly four deviations below.
LEAST_SHARED = 28
SIMILAR = 0.8
WORDS = 5
#: Members up to which all pairs of a posting list are compared at once.
SHORT = 16
#: Holders of a shingle that are one block of its list.
LIST = 512
#: Prefix shingles up to which an entry carries its whole prefix; pairs of longer ones may be found in several lists.
CARRIED = 128


def sampled_bytes(hashes: np.ndarray, factors: np.ndarray, block: int = 1 << 13) -> bytes:
    """One byte per permutation; zeros without shingles."""
    if not len(hashes):
        return bytes(len(factors))
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), block):
        np.minimum(least, (hashes[None, i:i + block] * factors[:, None]).min(1), out=least)
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()


def _factors() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, SAMPLED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sampled(texts: DataFrame, words: int) -> DataFrame:
    """``key, bytes`` of ``texts(key, text)``."""
    factors = _factors()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [sampled_bytes(shingle_hashes(t or "", words), factors) for t in batch_rows(b, "text")[0]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["key", "bytes"])

    return texts.select("key", "text").mapInArrow(hashed, "key bigint, bytes binary")


def _shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """``key, shingles`` (distinct, 32 bits each) of ``texts(key, text)``."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [np.unique(shingle_hashes(t or "", words).astype(np.uint32)).view(np.int32) for t in batch_rows(b, "text")[0]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["key", "shingles"])

    return texts.select("key", "text").mapInArrow(hashed, "key bigint, shingles array<int>")


def _posts(prints: DataFrame) -> DataFrame:
    """``choice, part, key, low, members``: every key's places in posting lists of two members or more, with least member and size."""
    lists = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("choice"), F.substring("bytes", 1 + GROUP * i, GROUP).alias("part"))
                      for i in range(LISTS)])
    index = prints.select("key", F.explode(lists).alias("post")).select("key", "post.*")
    busy = (index.groupBy("choice", "part").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("members"))
            .where("low < high").select("choice", "part", "low", "members"))
    return index.join(busy, ["choice", "part"])


def _meetings(posts: DataFrame) -> DataFrame:
    """Candidate pairs ``(a, b)``, a < b: all pairs of a short list; in a long one each member with the least and a neighbour.

    Rows out are in proportion to rows in, whatever the size of a list. Long
    lists spread over tasks, as they are dealt by list and member; their other
    pairs are left to ``_prefix_pairs``.
    """
    whole = posts.where(F.col("members") <= SHORT).groupBy("choice", "part").agg(F.collect_list("key").alias("keys"))
    rest = lambda a: F.filter("keys", lambda b: b > a)
    every = F.flatten(F.transform("keys", lambda a: F.transform(rest(a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    dealt = (posts.where(F.col("members") > SHORT).withColumn("turn", F.xxhash64("key", "choice"))
             .repartitionByRange("choice", "part", "turn").sortWithinPartitions("choice", "part", "turn"))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            out = []
            for choice, part, key, low in zip(*batch_rows(b, "choice", "part", "key", "low")):
                if low != key:
                    out.append((low, key))
                if last and last[:2] == (choice, part) and last[2] not in (low, key) and key != low:
                    out.append((min(last[2], key), max(last[2], key)))
                last = (choice, part, key)
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return (whole.select(F.explode(every).alias("pair")).select("pair.*")
            .unionByName(dealt.mapInArrow(neighbours, "a bigint, b bigint")).distinct())


def _sets_of(docs: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """Stored shingle sets of ``keys(wanted)``; texts stay where they are read if the keys are few enough to be sent."""
    wanted = sent_if_small(keys, 16)
    return stored(_shingle_sets(docs.join(wanted, docs["key"] == wanted["wanted"], "left_semi"), words)
                  .groupBy("key").agg(F.first("shingles").alias("shingles")), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets are at least ``similar``."""
    left, right = (sets.select(F.col("key").alias(k), F.col("shingles").alias(f"{k}_set")) for k in "ab")
    both = F.size(F.array_intersect("a_set", "b_set"))
    every = F.size("a_set") + F.size("b_set")
    return pairs.join(left, "a").join(right, "b").where(both >= similar * (every - both)).select("a", "b")


def _list_pairs(rows: dict, similar: float, slack: float) -> Iterator[tuple[int, int]]:
    """Pairs of places in a posting list whose sets can be ``similar`` and that first meet in this list.

    ``rows`` has arrays ``key, root, n, before, first, block`` and lists
    ``prefix``. Block by block of 256 rows, nothing but the pairs found is kept.
    """
    order = np.lexsort((rows["key"], rows["n"]))
    key, root, n, before, first, block = (rows[c][order] for c in ("key", "root", "n", "before", "first", "block"))
    left, split = n - before, block.min() != block.max()
    earlier: dict[int, frozenset | None] = {}

    def before_here(i):
        # The shingles of the prefix that come before this list's; None where the prefix was too long to carry.
        if i not in earlier:
            prefix = rows["prefix"][order[i]]
            earlier[i] = None if prefix is None else frozenset(prefix[:before[i] - rows["alone"][order[i]]])
        return earlier[i]

    for at in range(0, len(key), 256):
        a = slice(at, at + 256)
        shorter = np.arange(len(key))[a, None]
        ok = (first[a, None] & (root[a, None] != root) & (np.arange(len(key)) > shorter) & (n[a, None] + slack >= similar * n)
              & (np.minimum(left[a, None], left) * (1 + similar) + slack >= similar * (n[a, None] + n)))
        if split:  # pairs within a block are found where the block meets itself
            ok &= block[a, None] != block
        for i, j in zip(*(x.tolist() for x in np.nonzero(ok))):
            one, other = before_here(at + i), before_here(j)
            if one is None or other is None or one.isdisjoint(other):
                yield order[at + i], order[j]


def _prefix_pairs(sets: DataFrame, roots: DataFrame, similar: float) -> DataFrame:
    """Pairs ``(a, b)`` of ``sets(key, shingles)`` with different ``roots(key, root)``: every pair that can be ``similar``.

    Shingles are ordered by the number of sets that hold them, rare ones first.
    Two sets that are similar share a shingle among the first ``n - ceil(2 s n / (1 + s)) + 1``
    of the shorter one's n and the first ``n - ceil(s n) + 1`` of the longer
    one's, and as many must follow the first shared one as the similarity asks
    for. The holders of a shingle are compared in numpy blocks, and only pairs
    that pass these tests, that are not connected yet and that meet in no earlier
    list leave the task. Long lists are cut into blocks by hash, and every pair
    of blocks is a group of its own.
    """
    # A small allowance, so that no rounding shortens a prefix.
    slack = 1e-9
    held = sets.select("key", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    spread = stored(held.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1"), "holders")
    n, before = F.col("n"), F.col("alone") + F.col("place")
    # Shingles of a single set find no partner; they only hold places in front.
    ordered = (held.join(spread, "shingle").groupBy("key", "n")
               .agg(F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("order"))
               .withColumn("alone", n - F.size("order"))
               .withColumn("prefix", F.slice(F.transform("order", lambda s: s["shingle"]), 1, F.greatest(
                   (n - F.ceil(similar * n - slack) - F.col("alone") + 1).cast("int"), F.lit(0))))
               .join(roots, "key"))
    entries = stored(ordered.select("key", "root", "n", "alone", F.when(F.size("prefix") <= CARRIED, F.col("prefix")).alias("carried"),
                                    F.posexplode("prefix").alias("place", "shingle"))
                     .select("key", "root", "n", "alone", "carried", "shingle", before.alias("before"),
                             (before <= n - F.ceil(2 * similar / (1 + similar) * n - slack)).alias("first")), "prefixes")
    lists = (entries.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("root").alias("low"), F.max("root").alias("high"), F.max("first").alias("led"))
             .where("low < high and led").select("shingle", F.ceil(F.col("holders") / LIST).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = entries.join(lists, "shingle").withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    fields = ["key", "root", "n", "alone", "before", "first", "block", "carried"]
    groups = (dealt.groupBy("shingle", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
              .agg(F.collect_list(F.struct(*fields)).alias("rows")).where("size(rows) > 1").select("rows"))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(0)
            flat = dict(zip(fields, rows.flatten().flatten()))
            carried = flat.pop("carried").to_pylist()
            flat = {c: v.to_numpy(zero_copy_only=False) for c, v in flat.items()}
            ends = np.cumsum([0, *rows.value_lengths().to_pylist()])
            pairs = []
            for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
                part = {c: v[x:y] for c, v in flat.items()} | {"prefix": carried[x:y]}
                pairs += [(part["key"][i], part["key"][j]) for i, j in _list_pairs(part, similar, slack)]
            out = np.sort(np.array(pairs, np.int64).reshape(-1, 2), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

    return groups.mapInArrow(paired, "a bigint, b bigint").distinct()


def similar_links(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """Verified links ``(a, b)`` between keys of ``docs(key, text)`` that connect all similar ones; one text per key."""
    prints = stored(_sampled(docs, words).groupBy("key").agg(F.first("bytes").alias("bytes")), "prints")
    posts = stored(_posts(prints), "posts")
    pairs = _meetings(posts)
    left, right = (prints.select(F.col("key").alias(k), F.col("bytes").alias(f"{k}_bytes")) for k in "ab")
    equal = sum(((F.substring("a_bytes", i + 1, 1) == F.substring("b_bytes", i + 1, 1)).cast("int") for i in range(SAMPLED)), F.lit(0))
    counted = stored(pairs.join(left, "a").join(right, "b").where(equal >= LEAST_SHARED).select("a", "b"), "pairs")
    wanted = stored(counted.select(F.explode(F.array("a", "b")).alias("wanted")).distinct(), "wanted")
    links = stored(_verified(counted, _sets_of(docs, wanted, words), similar), "links")
    # What the long lists leave open: members of one list that are not connected yet.
    long = posts.where(F.col("members") > SHORT).select("choice", "part", "key")
    if long.isEmpty():
        return links
    roots = connected_components(links)
    named = stored(long.join(roots, long.key == roots.node, "left").select("choice", "part", "key", F.coalesce("root", "key").alias("root")), "named")
    mixed = named.groupBy("choice", "part").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_ = stored(named.join(mixed.select("choice", "part"), ["choice", "part"]).select("key", "root").distinct(), "open")
    if open_.isEmpty():
        return links
    sets = _sets_of(docs, open_.select(F.col("key").alias("wanted")), words)
    more = stored(_prefix_pairs(sets, open_, similar), "prefix-pairs")
    return links.unionByName(_verified(more, sets, similar))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """Rows of ``docs`` (all columns) of which one per group of equal or similar texts stays.

    A link is a Jaccard similarity of at least ``similar`` of the sets of
    ``words``-word shingles; groups are connected. The row with the least
    ``doc_id`` stays (null ids last, one of repeated rows). Texts without
    a word (null, empty, blank) are equal. Texts are told apart by a 64-bit hash. Pairs meet in at least one
    of twelve posting lists with a probability of 0.998 at similarity 0.8 and
    nearer 1 above. All pairs of a short list are compared; members of a long
    list that comparing with the least one and a neighbour leaves unconnected are
    joined by the first shingles of their sets, which misses no pair.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    rows = stored(keyed.groupBy("key", "doc_id").agg(F.count("*").alias("n")), "keys")
    links = stored(similar_links(keyed.select("key", "text"), words, similar), "links")
    roots = connected_components(links)
    placed = rows.join(roots, rows.key == roots.node, "left").select(
        "key", "doc_id", "n", F.coalesce("root", "key").alias("root"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    # Stored, so that the join below is one that Spark can split where a group is large.
    winners = stored(placed.groupBy("root").agg(F.min_by(F.struct("key", "doc_id"), order).alias("best")), "winners")
    judged = stored(placed.join(winners, "root").select(
        "key", "doc_id", "n", (same(F.col("best.key"), F.col("key")) & same(F.col("best.doc_id"), F.col("doc_id"))).alias("stays")), "judged")
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))

    def of(rows: DataFrame):
        return (own == rows["key"]) & same(docs["doc_id"], rows["doc_id"])

    losers = sent_if_small(judged.where("not stays"), 32)
    repeated = judged.where("stays and n > 1")
    if repeated.isEmpty():
        return docs.join(losers, of(losers), "left_anti")
    others = judged.where("not stays or n > 1")
    single = docs.join(others, of(others), "left_anti")
    return single.unionByName(docs.join(repeated, of(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))
