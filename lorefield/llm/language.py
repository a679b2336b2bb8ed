"""Language identification by rank-order profiles.

A language is described by the ranks of its most frequent letter n-grams (one to
five letters, words padded with spaces); so is a document, and the document goes
to the language from whose ranks its own are least out of place. N-grams that a
language does not list count as the greatest distance.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lorefield.llm.common import batch_rows, fold_of

LONGEST = 5
#: N-grams of a profile.
DOCUMENT_RANKS, LANGUAGE_RANKS = 300, 1000
#: Training rows of a language, on average: the bound of the fit.
SAMPLE = 1000
#: Bits of the largest collision-free table of n-grams.
TABLE_BITS = 22
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + n] for n in range(1, LONGEST + 1) for i in range(len(padded) - n + 1) if padded[i:i + n] != " "]


def gram_counts(text: str) -> Counter:
    """N-grams of a text's words; lower case, letters only."""
    counts = Counter()
    for word, n in Counter(_LETTERS.findall(text.lower())).items():
        for g in grams(word):
            counts[g] += n
    return counts


class RankProfiles:
    """Ranks by n-gram and language; ``ranks[i, j]`` is the place of n-gram i in language j.

    N-grams are looked up by a 64-bit hash for all places of a text at once: in a
    table without collisions while that has at most ``TABLE_BITS`` bits (some
    5,000 n-grams), among sorted hashes beyond, so its size follows the n-grams.
    """

    def __init__(self, languages: tuple[str, ...], listed: list[str], ranks: np.ndarray):
        self.languages, self.ranks = languages, ranks
        letters = sorted({c for g in listed for c in g if c != " "})
        self.codes = {c: i + 2 for i, c in enumerate(letters)}  # 0: between words, 1: a letter of no profile
        self.table = np.zeros(max(map(ord, letters), default=0) + 1, np.int64)
        for c, k in self.codes.items():
            self.table[ord(c)] = k
        keys = np.array([self._key([self.codes.get(c, 0) for c in g]) for g in listed], np.uint64)
        self.bits = max(12, int(len(listed) ** 2 // 6).bit_length())
        self.keys = np.append(keys, np.uint64(0))
        self.sorted = np.argsort(keys, kind="stable") if self.bits > TABLE_BITS else None
        turn = np.random.default_rng(5)
        while self.sorted is None:
            self.factor = np.uint64(int(turn.integers(1 << 62)) * 2 + 1)
            slots = (keys * self.factor) >> np.uint64(64 - self.bits)
            if len(np.unique(slots)) == len(keys):
                self.slots = np.full(1 << self.bits, len(listed), np.int32)
                self.slots[slots.astype(np.int64)] = np.arange(len(listed))
                break

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash the number of the n-gram that can have it."""
        if self.sorted is None:
            return self.slots[((hashes * self.factor) >> np.uint64(64 - self.bits)).astype(np.int64)]
        at = np.searchsorted(self.keys[:-1], hashes, sorter=self.sorted)
        return np.append(self.sorted, len(self.sorted))[at]

    @staticmethod
    def _key(codes: list[int]) -> int:
        h = 0
        for c in codes:
            h = (h * 0x9E3779B97F4A7C15 + c + 1) & (1 << 64) - 1
        return h

    def _letters(self, text: str) -> np.ndarray:
        """Codes of the letters, words apart by one 0 and with 0 at both ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.table[np.minimum(points, len(self.table) - 1)]
        codes[points >= len(self.table)] = 0
        for p in np.unique(points[codes == 0]).tolist():
            if p > 64 and chr(p).isalpha():
                codes[points == p] = 1
        codes = np.concatenate([[0], codes, [0]])
        keep = np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))
        return codes[keep]

    def counts(self, text: str) -> np.ndarray | None:
        """How often each listed n-gram occurs; None without a letter."""
        codes = self._letters(text)
        if not codes.any():
            return None
        gap = codes == 0
        plus = codes.astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(self.keys), np.int64)
        h, inner = np.zeros(len(codes), np.uint64), np.zeros(len(codes), bool)
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            size = len(codes) - n + 1
            h = h[:size] * np.uint64(0x9E3779B97F4A7C15) + plus[n - 1:]
            if n > 2:  # a gap is first or last in an n-gram, never within
                inner = inner[:size] | gap[n - 2:n - 2 + size]
            at = self._places(h)
            good = self.keys[at] == h
            if n > 2:
                good &= ~inner
            total += np.bincount(at[good], minlength=len(total))
        return total[:-1]

    def predict(self, text: str) -> tuple[str, float]:
        """Language and a score: one minus the mean displacement over the greatest one."""
        counts = self.counts(text) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        # N-grams of no profile are equally far from every language: they move no decision.
        seen = np.flatnonzero(counts)
        if not len(seen):
            return self.languages[0], 0.0
        top = seen[np.argsort(-counts[seen], kind="stable")[:DOCUMENT_RANKS]]
        ranks = self.ranks[top]
        away = np.where(ranks >= LANGUAGE_RANKS, LANGUAGE_RANKS, np.abs(ranks - np.arange(len(top))[:, None])).sum(0)
        best = int(away.argmin())
        return self.languages[best], float(1 - away[best] / (LANGUAGE_RANKS * len(top)))


def train_profiles(docs: DataFrame, sample: int = SAMPLE) -> RankProfiles:
    """Profiles from ``docs(doc_id, text, lang)`` outside the held-out fold with a language.

    About ``sample`` rows of each language take part. Counts are summed in
    Spark; only the profiles, a fixed number of n-grams of each language, come
    to the driver.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT))
    sizes = rows.groupBy("lang").count()
    # By a hash of the row, so that the draw is the same however the table is laid out.
    turn = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id", "text"), 11).cast("double") / F.lit(float(1 << 53))
    drawn = (rows.select("text", "lang", turn.alias("turn")).join(F.broadcast(sizes), "lang")  # a row per language
             .where(F.col("turn") < F.lit(sample) / F.col("count")).select("text", "lang"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter] = {}
        for b in batches:
            for text, lang in zip(*batch_rows(b, "text", "lang")):
                sums.setdefault(lang, Counter()).update(gram_counts(text))
            if sum(map(len, sums.values())) > 1_000_000:
                yield packed(sums)
                sums = {}
        yield packed(sums)

    def packed(sums: dict) -> pa.RecordBatch:
        flat = [(lang, g, n) for lang, c in sums.items() for g, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.string()), pa.array([f[1] for f in flat], pa.string()),
                                           pa.array([f[2] for f in flat], pa.int64())], names=["lang", "gram", "n"])

    counts = drawn.mapInArrow(counted, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(place) - 1).where(F.col("rank") < LANGUAGE_RANKS)
    listed = top.select("lang", "gram", "rank").toArrow().to_pydict()
    languages = tuple(sorted(set(listed["lang"])))
    index = {g: i for i, g in enumerate(sorted(set(listed["gram"])))}
    ranks = np.full((len(index), len(languages)), LANGUAGE_RANKS, np.int64)
    for lang, gram, rank in zip(listed["lang"], listed["gram"], listed["rank"]):
        ranks[index[gram], languages.index(lang)] = rank
    return RankProfiles(languages, sorted(index), ranks)


def predicted_language(profiles: RankProfiles, text: Column) -> Column:
    """``lang_pred, score`` as one column."""
    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            found = [profiles.predict(x or "") for x in t.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             names=["lang_pred", "score"])

    return predict.asNondeterministic()(text)


def identify_language(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs(doc_id, text, lang)``.

    ``und`` and 0 for null texts, texts without a letter and when there is no
    training row. Ties go to the first language by name. Rows without an id are
    not held out and not learnt from. Repeated rows give repeated rows, other
    columns are ignored, an empty table gives an empty table.
    """
    profiles = train_profiles(docs)
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), predicted_language(profiles, F.col("text")).alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score")
