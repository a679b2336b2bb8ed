"""Text quality by compression with two dictionaries.

A zstandard dictionary is trained on texts labelled good and one on texts
labelled bad. A text is compressed with both, in windows, so that a long text
does not become its own dictionary. What the bad dictionary needs more than the
good one, per byte of text, is the text's difference; a logistic curve fitted to
other labelled texts turns it into a score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lorefield.llm.common import batch_rows, fold_of

HELD_OUT = 2
FOLDS = 4
THRESHOLD = 0.7
#: Labelled rows of each class that take part in fitting, at most: half of them make the dictionaries, half the curve.
SAMPLE = 6000
#: Windows of a text that go into a dictionary, at most, evenly over the whole text. Scores read all windows.
LEARNT = 6
WINDOW = 1024
DICTIONARY = 112_640
LEVEL = 3


def windows(data: bytes, size: int = WINDOW) -> list[bytes]:
    return [data[i:i + size] for i in range(0, len(data), size)]


def build_dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; samples that are too few to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 4)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class Compressors:
    """The two dictionaries made ready; one per task."""

    def __init__(self, good: bytes, bad: bytes):
        self.both = []
        for data in (good, bad):
            options = dict(write_checksum=False, write_content_size=False, write_dict_id=False)
            if data:
                options["dict_data"] = zstandard.ZstdCompressionDict(data)
                options["dict_data"].precompute_compress(level=LEVEL)
            self.both.append(zstandard.ZstdCompressor(level=LEVEL, **options))

    def difference(self, text: str | None) -> float:
        """Bytes that the bad dictionary needs more than the good one, per byte of the whole text; 0 without text."""
        data = (text or "").encode("utf-8", "surrogatepass")
        good, bad = (sum(len(c.compress(w)) for w in windows(data)) for c in self.both)
        return (bad - good) / max(len(data), 1)


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and curve: ``1 / (1 + exp(-(slope * difference + offset)))``."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def curve(self, differences) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(differences, np.float64) + self.offset, -30, 30)))


def fit_curve(differences, labels, weights, ridge: float = 1e-3, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit, by Newton steps on standardised differences."""
    x, y, w = (np.asarray(v, np.float64) for v in (differences, labels, weights))
    if not len(x):
        return 0.0, 0.0
    mean, deviation = np.average(x, weights=w), max(np.sqrt(np.average((x - np.average(x, weights=w)) ** 2, weights=w)), 1e-9)
    z, w = np.stack([(x - mean) / deviation, np.ones(len(x))], 1), w / w.sum()
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (w * (p - y)) + ridge * beta
        curve = (z * (w * p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        move = np.linalg.solve(curve, slope)
        beta -= move / max(1.0, np.abs(move).max() / 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(beta[0] / deviation), float(beta[1] - beta[0] * mean / deviation)


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """``text, doc_id, good, builds`` of at most ``sample`` labelled ids of each class outside the held-out fold, and all such ids by class."""
    rows = labels.where((fold_of("doc_id", FOLDS) != HELD_OUT) & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("good")).distinct()
    known = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
    least = [rows.where(F.col("good") == q).orderBy(F.xxhash64("labelled"), "labelled").limit(sample) for q in (0, 1)]
    # At most two times ``sample`` ids.
    ids = F.broadcast(least[0].unionByName(least[1]))
    builds = F.pmod(F.shiftright(F.xxhash64("labelled"), 7), F.lit(2)) == 0
    return docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("labelled")).withColumn("builds", builds), known


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, quality)``.

    Labels are read of rows outside the held-out fold only. At most ``sample``
    ids of each class (least hashes) take part, and of an id's rows the ``sample``
    least by hash: a documented bound of the fit, so that at most some 70 MB of windows and
    a number per row reach the driver. Half of the ids make the dictionaries;
    the curve is fitted to the others, weighted to the shares of all labels.
    Without labels every text scores a half; a class that is alone is what every text scores.
    """
    rows, known = _sampled(docs, labels, sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in batch_rows(b, "text")[0]:
                parts = windows((text or "").encode("utf-8", "surrogatepass"))
                out.append([parts[i * len(parts) // LEARNT] for i in range(LEARNT)] if len(parts) > LEARNT else parts)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.list_(pa.binary()))], names=["good", "turn", "parts"])

    turn = F.xxhash64("doc_id", "text").alias("turn")
    learnt = rows.where("builds").select("text", "good", turn).mapInArrow(cut, "good int, turn bigint, parts array<binary>")
    samples = {q: [p for r in learnt.where(F.col("good") == q).orderBy("turn").limit(sample).collect() for p in r["parts"]] for q in (0, 1)}
    good, bad = build_dictionary([bytes(p) for p in samples[1]]), build_dictionary([bytes(p) for p in samples[0]])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Compressors(good, bad)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array([both.difference(t) for t in batch_rows(b, "text")[0]], pa.float64())],
                                             names=["good", "turn", "difference"])

    others = rows.where("not builds").select("text", "good", turn).mapInArrow(compared, "good int, turn bigint, difference double")
    fitted = [r for q in (0, 1) for r in others.where(F.col("good") == q).orderBy("turn").limit(sample).collect()]
    used = {q: sum(r["good"] == q for r in fitted) for q in (0, 1)}
    slope, offset = fit_curve([r["difference"] for r in fitted], [r["good"] for r in fitted], [known[r["good"]] / used[r["good"]] for r in fitted])
    return QualityModel(good, bad, slope, offset)


def quality_score(model: QualityModel):
    """A function from a text column to scores; a null text counts as empty."""
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        both = Compressors(model.good, model.bad)
        for t in texts:
            yield pa.array(model.curve([both.difference(x) for x in t.to_pylist()]), pa.float64())

    return score.asNondeterministic()


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Empty and null texts get the score of no difference; long texts are
    compressed whole, window by window. A null ``doc_id`` is in no held-out fold
    and has no label; an id with both labels counts for both. Repeated rows give repeated rows; other columns are
    ignored; empty tables give an empty table.
    """
    score = quality_score(train_quality(docs, labels, sample))
    return (docs.select("doc_id", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                        score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
