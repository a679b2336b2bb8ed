"""Toxicity scores by non-negative positive-unlabelled learning.

A linear model over hashed words and word beginnings is fitted with numpy to
confirmed toxic texts (positives) and to texts of unknown label. Its risk is

    prior * E_pos[l(+1)] + max(0, E_unl[l(-1)] - prior * E_pos[l(-1)])

with the logistic loss; when the part in the maximum turns negative the step
goes up along that part instead, which keeps a flexible model from learning the
positives by heart.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorefield.llm.common import batch_rows, fold_of, turn_of

#: Rows used for fitting, at most (positives) and on average (unlabelled).
POSITIVES, UNLABELLED = 4000, 12000
BITS = 18
MARKS = ".,;:!?\"'()[]|"
HELD_OUT = 1
FOLDS = 3
THRESHOLD = 0.7
WORDS_KEPT = 100_000


def features(text: str, known: dict) -> np.ndarray:
    """Hashed words, their first four and their first five letters; each once."""
    mask = (1 << BITS) - 1
    out = []
    for raw in set(text.lower().split()):
        ids = known.get(raw)
        if ids is None:
            if len(known) >= WORDS_KEPT:
                known.clear()
            w = raw.strip(MARKS).encode("utf-8", "surrogatepass")
            c = raw.strip(MARKS)
            ids = known[raw] = tuple({zlib.crc32(w) & mask} | {
                zlib.crc32(b"^" + c[:k].encode("utf-8", "surrogatepass")) & mask for k in (4, 5) if len(c) > k})
        out.extend(ids)
    return np.unique(np.array(out, dtype=np.int32))


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by feature and a bias; ``score`` gives probabilities."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list, known: dict) -> list[float]:
        return [float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[features(t or "", known)].sum(dtype=np.float64), -30, 30))))
                for t in texts]


def risk_slope(z: np.ndarray, pos: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """The positive and the negative part of the risk of scores ``z``, and the slope of a step in ``z``.

    The slope is that of the whole risk, or that of the negative part turned
    round where it is below zero.
    """
    n_pos, n_unl = pos.sum(), (~pos).sum()
    p = 1 / (1 + np.exp(-z))
    minus = np.logaddexp(0, z)  # loss of calling a row negative
    gain = prior * np.logaddexp(0, -z)[pos].mean()
    negative = minus[~pos].mean() - prior * minus[pos].mean()
    down = np.where(pos, -prior / n_pos * p, p / n_unl)  # slope of the negative part
    return gain, negative, down + np.where(pos, prior / n_pos * (p - 1), 0) if negative >= 0 else -down


def fit_nnpu(positive: list, unlabelled: list, prior: float, epochs: int = 250, rate: float = 0.05,
             ridge: float = 1e-4, apart: float = 4.0) -> ToxicityModel:
    """Fit from lists of feature arrays.

    Only features take part whose share among positives and unlabelled rows
    differs by ``apart`` standard errors: chance features are what the risk
    overfits to.
    """
    weights = np.zeros(1 << BITS)
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    if not positive or not unlabelled:
        return ToxicityModel(weights.astype(np.float32), float(np.log(prior / (1 - prior))))
    rows = positive + unlabelled
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n_pos, n_unl = len(positive), len(unlabelled)
    split = sum(map(len, positive))
    p, u = (np.bincount(x, minlength=1 << BITS) / n for x, n in ((flat[:split], n_pos), (flat[split:], n_unl)))
    both = (p * n_pos + u * n_unl + 1) / len(rows)
    telling = np.abs(p - u) >= apart * np.sqrt(both * (1 / n_pos + 1 / n_unl))
    flat, owner = flat[telling[flat]], owner[telling[flat]]
    used, flat = np.unique(flat, return_inverse=True)
    w, bias = np.zeros(len(used)), np.log(prior / (1 - prior))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    pos = np.arange(len(rows)) < n_pos
    mean_w, mean_bias, last = np.zeros(len(used)), 0.0, epochs // 3  # the steps turn around at the bound: the last ones are averaged
    for step in range(1, epochs + 1):
        z = np.clip(bias + np.bincount(owner, w[flat], len(rows)), -30, 30)
        slope = risk_slope(z, pos, prior)[2]
        grad = np.append(np.bincount(flat, slope[owner], len(used)) + ridge * w, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
        if step > epochs - last:
            mean_w, mean_bias = mean_w + w / last, mean_bias + bias / last
    weights[used] = mean_w
    return ToxicityModel(weights.astype(np.float32), float(mean_bias))


def train_toxicity(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
                   unlabelled: int = UNLABELLED) -> ToxicityModel:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    Labels are read of the rows outside the held-out fold only. At most
    ``positives`` toxic ids (least hashes) and about ``unlabelled`` rows, drawn by
    a hash of the row, take part: a documented bound of the fit. The model is the
    same however the tables are laid out. The class prior is the toxic share
    of all labelled rows outside the held-out fold, drawn towards a tenth by ten
    rows. Without positives every text scores the prior.
    """
    rows = labels.where((fold_of("doc_id", FOLDS) != HELD_OUT) & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    toxic_rows, all_rows = rows.agg(F.coalesce(F.sum(F.col("toxic").cast("int")), F.lit(0)), F.count("*")).first()
    prior = (toxic_rows + 1) / (all_rows + 10)  # as if ten more rows, one of them toxic, had been seen
    toxic = (rows.where("toxic = 1").select(F.col("doc_id").alias("toxic_id")).distinct()
             .orderBy(F.xxhash64("toxic_id"), "toxic_id").limit(positives))
    n = docs.count()
    texts = (docs.select("doc_id", "text").withColumn("drawn", turn_of(17, "doc_id", "text") < unlabelled / max(n, 1))
             .join(F.broadcast(toxic), F.col("doc_id") == F.col("toxic_id"), "left")
             .where(F.col("toxic_id").isNotNull() | F.col("drawn"))
             .select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic_id").isNotNull().alias("toxic"), "drawn"))

    def featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for b in batches:
            words = [features(t, known).tobytes() for t in batch_rows(b, "text")[0]]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(words, pa.binary())],
                                             names=["toxic", "drawn", "words"])

    got = texts.mapInArrow(featurised, "toxic boolean, drawn boolean, words binary").toArrow().to_pydict()
    rows = sorted(zip(got["words"], got["toxic"], got["drawn"]))
    return fit_nnpu([np.frombuffer(x, np.int32) for x, y, _ in rows if y], [np.frombuffer(x, np.int32) for x, _, y in rows if y], prior)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score column; a null text counts as empty."""
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = {}
        for t in texts:
            yield pa.array(model.score(t.to_pylist(), known), pa.float64())

    return score.asNondeterministic()(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Empty and null texts get the score of no words. A null ``doc_id`` is in no
    held-out fold and has no label. Repeated rows give repeated rows; other
    columns are ignored; empty tables give an empty table.
    """
    model = train_toxicity(docs, labels)
    return (docs.select("doc_id", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                        toxicity_score(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` below the threshold, with all their columns.

    Null and empty texts have the score of no words, long texts are scored
    whole. Repeated rows have one score and go or stay together; null ids are
    judged by their text. Without labels every row scores a prior below the
    threshold and stays; an empty table gives an empty table.
    """
    model = train_toxicity(docs, labels)
    return docs.where(toxicity_score(model, F.col("text")) < threshold)
