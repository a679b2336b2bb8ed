"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

A spaced seed is a fixed mask over consecutive words that ignores some of them:
two passages that differ in an ignored word still share the seed's hash. Hashes
of all test and training positions are joined; around each hit the two texts
are compared word by word along the hit's diagonal, and the best stretch has to
reach a score that allows substitutions.

No stretch that reaches its score is without a seed. A stretch of x other words
has x + 1 runs of equal ones, of r words each, and its score is the sum of
r - 2 over the runs, plus 2. Without a seed no run has four words, and a run of
three has none or one in the runs at its sides. So each run that adds 1 is
followed by one that takes as much, but for the last, and the score is 3 at
most; 5 is the least score that is asked for.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lorefield.llm.common import BROADCAST_BYTES, same, stored

#: Masks, 1: the word counts, 0: it is ignored; four words, or five around one that is ignored.
SEEDS = ("1111", "111011", "110111")
#: Items of fewer words are found only where all their words stand in a row.
SPAN = 10
#: A stretch scores 1 for an equal word and this much for another one.
MISMATCH = -2
#: Score that a stretch must reach; half the words of a shorter item.
SCORE = 10


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-case runs of letters and digits."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seed_hashes(words: Column, lengths: Sequence[int] = ()) -> Column:
    """Seed hashes of every position: all of the first mask, then all of the next.

    Where a mask does not fit, its hash is of fewer words and equals none of a
    place where it does. After the masks come runs of the given ``lengths``, with a tag of their own.
    """
    def of(mask: str, tag: int) -> Column:
        at = [k for k, bit in enumerate(mask) if bit == "1"]
        return F.transform(words, lambda w, i: F.xxhash64(F.lit(tag), *[F.get(words, i + k) if k else w for k in at]))
    return F.concat(*[of(m, n) for n, m in enumerate(SEEDS)], *[of("1" * n, -n) for n in lengths])


def _seeds(df: DataFrame, key: str, lengths: Sequence[int] = ()) -> DataFrame:
    """``key, words, tag, start, seed``: a row per position and mask, then per position and length."""
    words = df.withColumn("words", word_hashes(F.col("text"))).select(key, "words")
    hashed = words.withColumn("seeds", seed_hashes(F.col("words"), lengths))
    # The outer form keeps Spark from adding a filter that would compute all hashes once more.
    return (hashed.select(key, "words", F.posexplode_outer("seeds").alias("place", "seed")).where("seed is not null")
            .withColumn("start", F.col("place") % F.size("words"))
            .withColumn("tag", F.floor(F.col("place") / F.size("words")).cast("int")).drop("place"))


def _leads(words: Column, start: Column, item: Column, item_start: Column, tag: Column) -> Column:
    """Whether a hit is the first of its run on its diagonal, or has another word in its gap: all else is found by these."""
    at = F.get(F.array(*[F.lit(m.find("0")) for m in SEEDS]), tag)
    return (tag >= len(SEEDS)) | ((at < 0) & ((start == 0) | (item_start == 0))) | (F.get(words, start + at) != F.get(item, item_start + at))


def _beside(words: Column, start: Column, tag: Column) -> Column:
    """The word that ``_leads`` compares, for sides that meet without their words; null where a hit leads in any case."""
    at = F.get(F.array(*[F.lit(m.find("0")) for m in SEEDS]), tag)
    return F.when(tag < len(SEEDS), F.get(words, start + at))


def _best_stretch(doc: Column, item: Column, shift: Column) -> Column:
    """Best stretch along a diagonal: ``score, first, last`` (item positions) and ``equal`` words in it."""
    empty = F.struct(*[F.lit(0).alias(c) for c in ("run", "open", "hits", "score", "first", "last", "equal")])
    def step(acc, i):
        hit = F.coalesce(F.get(doc, i + shift) == F.get(item, i), F.lit(False))
        gain = F.when(hit, 1).otherwise(MISMATCH)
        anew = acc.run <= 0
        run = F.when(anew, 0).otherwise(acc.run) + gain
        opened = F.when(anew, i).otherwise(acc.open)
        hits = F.when(anew, 0).otherwise(acc.hits) + hit.cast("int")
        better = run > acc.score
        return F.struct(run.alias("run"), opened.alias("open"), hits.alias("hits"),
                        F.when(better, run).otherwise(acc.score).alias("score"),
                        F.when(better, opened).otherwise(acc["first"]).alias("first"),
                        F.when(better, i).otherwise(acc["last"]).alias("last"),
                        F.when(better, hits).otherwise(acc.equal).alias("equal"))
    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), empty, step)


def _text_key(text: Column) -> Column:
    """Tells apart the texts of one id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _stretches(docs: DataFrame, items: DataFrame, score: int, broadcast_bytes: int) -> DataFrame:
    """``doc_id, text_key, item_id, shift, best``: stretches that reach their score, of every text by itself."""
    tests = items.select("item_id", word_hashes(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    tests = stored(tests.distinct().withColumn("test", F.xxhash64("item_id", "item_words")), "tests")
    lengths = sorted(r[0] for r in tests.select(F.size("item_words")).where(F.size("item_words") < SPAN).distinct().collect())
    n, spans = F.size("words"), [*map(len, SEEDS), *lengths]
    span = F.get(F.array(*[F.lit(k) for k in spans]), F.col("tag"))
    of_items = _seeds(items.select("item_id", "text"), "item_id", lengths).where(F.col("start") + span <= n).where(
        F.when(n >= SPAN, F.col("tag") < len(SEEDS)).otherwise((F.col("tag") >= len(SEEDS)) & (span == n)))
    posts = stored(of_items.select(F.xxhash64("item_id", "words").alias("test"), F.col("tag").alias("item_tag"),
                                   F.col("start").alias("item_start"), F.col("seed").alias("item_seed"),
                                   _beside(F.col("words"), F.col("start"), F.col("tag")).alias("item_beside")).distinct(), "seeds")
    size = posts.count() * 56 + (tests.agg(F.sum(F.size("item_words") * 8 + 64)).first()[0] or 0)
    owned = docs.select(F.struct("doc_id", _text_key(F.col("text")).alias("text_key")).alias("owner"), "text")
    seeds = _seeds(owned, "owner", lengths)
    shift = (F.col("start") - F.col("item_start")).alias("shift")
    leads = _leads(F.col("words"), F.col("start"), F.col("item_words"), F.col("item_start"), F.col("item_tag"))
    if size <= broadcast_bytes:
        hits = (seeds.join(F.broadcast(posts), F.col("seed") == F.col("item_seed")).join(F.broadcast(tests), "test")
                .where(leads).select("owner", "item_id", "words", "item_words", shift))
    else:
        # Of a run of hits on one diagonal the first is enough: all texts that hold a common passage make a row each, not one per word.
        a, b = F.col("beside"), F.col("item_beside")
        places = (seeds.select("owner", "start", "seed", _beside(F.col("words"), F.col("start"), F.col("tag")).alias("beside"))
                  .join(posts, (F.col("seed") == F.col("item_seed")) & (a.isNull() | b.isNull() | (a != b)))
                  .select("owner", "test", shift).distinct())
        texts = owned.select(F.col("owner.doc_id").alias("own_id"), F.col("owner.text_key").alias("own_text"), word_hashes(F.col("text")).alias("words"))
        hits = places.join(texts, same(F.col("owner.doc_id"), F.col("own_id")) & (F.col("owner.text_key") == F.col("own_text"))).join(tests, "test")
    # As a generator's output a stretch is computed once per hit and not inside the join, which stays compiled.
    stretch = _best_stretch(F.col("words"), F.col("item_words"), F.col("shift"))
    found = hits.select("owner.*", "item_id", "shift", F.size("item_words").alias("length"),
                        F.explode_outer(F.array(stretch)).alias("best"))
    return found.where(F.when(F.col("length") < SPAN, F.col("best.score") == F.col("length"))
                       .otherwise(F.col("best.score") * 2 >= F.least(F.lit(2 * score), F.col("length"))))


def benchmark_overlaps(docs: DataFrame, items: DataFrame, score: int = SCORE,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, item_id, score, equal_words, item_first, item_last, doc_first``: the best overlap per pair.

    ``docs(doc_id, text)`` and ``items(item_id, text)``. The seeds of the items
    are measured: a small table is broadcast and every position of a document is
    compared where it is read, without a shuffle; a large one is joined by seed,
    and only documents with hits are read again. Ties go to the earliest place
    in the item, then in the document. Null texts are empty and match nothing; items
    of fewer than 10 words match where a document holds all their words in a row. Null ids are kept as ids; repeated
    rows fold into one pair.
    """
    good = _stretches(docs, items, score, broadcast_bytes)
    rank = F.struct(F.col("best.score").alias("score"), (-F.col("best.first")).alias("item_first"),
                    (-F.col("best.first") - F.col("shift")).alias("doc_first"), F.col("best.last").alias("item_last"),
                    F.col("best.equal").alias("equal_words"))
    best = good.groupBy("doc_id", "item_id").agg(F.max(rank).alias("top"))
    return best.select("doc_id", "item_id", F.col("top.score").alias("score"), F.col("top.equal_words").alias("equal_words"),
                       (-F.col("top.item_first")).alias("item_first"), F.col("top.item_last").alias("item_last"),
                       (-F.col("top.doc_first")).alias("doc_first"))


def drop_contaminated(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``docs`` whose text overlaps no item, with all their columns.

    Rows that share an id, null ids too, are judged one by one by their text;
    equal rows go or stay together. Null and empty texts overlap nothing and
    stay, long texts and items are compared whole. Without items all rows stay;
    an empty table gives an empty table.
    """
    found = _stretches(docs, items, SCORE, broadcast_bytes)
    dirty = stored(found.select(F.col("doc_id").alias("dirty_id"), F.col("text_key").alias("dirty_text")).distinct(), "dirty")
    return docs.join(dirty, same(docs["doc_id"], dirty["dirty_id"]) & (_text_key(docs["text"]) == dirty["dirty_text"]), "left_anti")
