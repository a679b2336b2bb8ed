"""Model calls: embedding, generation, model tests and judging.

A model is any callable from a list of texts to a list of results; it runs in
the Python workers, one list per Arrow batch slice. Persist the result of a
model call before using it twice, or the model runs twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lorefield.functions.answers import extract_answer, parse_judgement, parse_qa
from lorefield.functions.strings import as_column
from lorefield.functions.templates import render_prompt
from lorefield.operators.remembered import answer_once, embed_once

Model = Callable[[list[str]], Sequence]

#: Prompts of one model call.
BATCH = 16

# Notes stored for rows whose call failed.
TEST_FAILED = "处理失败: "
JUDGE_FAILED = "评测过程出错: "


def embed(col: Column | str, encoder: Model | None = None, batch: int = 20,
          load: Callable[[], Model] | None = None, on_error: str = "raise", dim: int | None = None) -> Column:
    """``array<float>`` vectors of a text column, in batches.

    ``load`` builds the encoder once per Python worker. ``on_error='zero'``
    gives zero vectors of size ``dim`` for a batch that fails.
    """
    if (encoder is None) == (load is None):
        raise ValueError("give either an encoder or a loader")
    if on_error == "zero" and not dim:
        raise ValueError("zero vectors need a dimension")

    @F.pandas_udf("array<float>")
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder or load()
        for texts in parts:
            values = texts.fillna("").tolist()
            rows: list[np.ndarray] = []
            for at in range(0, len(values), batch):
                some = values[at:at + batch]
                try:
                    out = np.asarray(encode(some), dtype=np.float32)
                    if len(out) != len(some):
                        raise ValueError(f"{len(some)} texts gave {len(out)} vectors")
                except Exception:
                    if on_error != "zero":
                        raise
                    out = np.zeros((len(some), dim), dtype=np.float32)
                rows.extend(out)
            yield pd.Series(rows)

    # Without this mark Spark may encode once more to test a filter on the vectors.
    return vectors.asNondeterministic()(as_column(col))


def embed_texts(df: DataFrame, col: str, encoder: Model | None = None, out: str = "embedding", store: str | None = None,
                **options) -> DataFrame:
    """``df`` with vectors; with a ``store``, equal texts are encoded once, over runs too (see ``embed_once``)."""
    if store is not None:
        return embed_once(df, col, lambda texts, text: texts.withColumn("embedding", embed(text, encoder, **options)), store, out)
    return df.withColumn(out, embed(col, encoder, **options))


def _attempt(fn: Model, text: str, retries: int, delay: float, backoff: float):
    """Result, error text, calls and retries of one prompt."""
    for attempt in range(retries + 1):
        try:
            return fn([text])[0], None, attempt + 1
        except Exception as error:
            if attempt == retries:
                return None, str(error), attempt + 1
            time.sleep(delay * backoff ** attempt)


def _attempt_list(fn: Model, prompts: list[str], retries: int, delay: float, backoff: float) -> list[tuple]:
    """The same for a list of prompts, in one call if it succeeds."""
    if len(prompts) > 1:
        try:
            answers = list(fn(prompts))
            if len(answers) == len(prompts):
                return [(a, None, 1) for a in answers]
        except Exception:  # some prompt of the list cannot be answered: each is asked alone
            pass
    return [_attempt(fn, p, retries, delay, backoff) for p in prompts]


def call_model(df: DataFrame, prompt: str, fn: Model, out: str = "response", rounds: int = 1, retries: int = 0,
               delay: float = 0.0, backoff: float = 2.0, workers: int = 1, batch: int = BATCH, store: str | None = None) -> DataFrame:
    """Add the model's responses to each row, never dropping one.

    ``out`` is ``array<struct<response, error, calls>>`` with one entry per round:
    rounds stay in the row, so choosing among them needs no shuffle. The model
    gets lists of ``batch`` prompts; the prompts of a list that fails are asked
    one by one, with their own retries. Rows run in parallel by partition, and
    ``workers`` lists of a partition at a time, which pays when the model is a
    remote endpoint. With a ``store`` every distinct prompt is asked once, answers
    outlast a failed job, and a restart asks only for what is missing (see
    ``remembered``); errors count as answers.
    """
    if store is not None:
        def ask_rounds(prompts: list[str]) -> list[list[dict]]:
            answers = [_attempt_list(fn, prompts, retries, delay, backoff) for _ in range(rounds)]
            return [[dict(zip(("response", "error", "calls"), t)) for t in row] for row in zip(*answers)]

        return answer_once(df, prompt, ask_rounds, store, out, rounds, batch, workers)
    entry = "array<struct<response:string,error:string,calls:int>>"

    @F.pandas_udf(entry)
    def respond(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def ask(prompts: list[str]) -> list[list[dict]]:
            answers = [_attempt_list(fn, prompts, retries, delay, backoff) for _ in range(rounds)]
            return [[dict(zip(("response", "error", "calls"), t)) for t in row] for row in zip(*answers)]

        with ThreadPoolExecutor(workers) as pool:
            for texts in parts:
                prompts = ["" if t is None else t for t in texts]
                lists = [prompts[at:at + batch] for at in range(0, len(prompts), batch)]
                yield pd.Series([row for rows in pool.map(ask, lists) for row in rows], dtype=object)

    # The call is asked for once even where its result is read several times.
    return df.withColumn(out, respond.asNondeterministic()(F.col(prompt)))


def best_of_responses(responses: Column | str) -> Column:
    """``struct<question, answer>`` of the longest parsed pair, the earliest of equals; '' without any."""
    found = F.filter(F.transform(as_column(responses), lambda r: parse_qa(r["response"])), lambda q: q.isNotNull())
    size = lambda q: F.length(q["question"]) + F.length(q["answer"])
    empty = F.struct(F.lit("").alias("question"), F.lit("").alias("answer"))
    return F.aggregate(found, empty, lambda best, q: F.when(size(q) > size(best), q).otherwise(best))


def generate(df: DataFrame, prompt: str, fn: Model, rounds: int = 3, retries: int = 3, delay: float = 5.0,
             backoff: float = 2.0, workers: int = 1, batch: int = BATCH, store: str | None = None) -> DataFrame:
    """Question and answer per row from ``rounds`` generations, with call counters."""
    asked = call_model(df, prompt, fn, "_responses", rounds, retries, delay, backoff, workers, batch, store)
    counted = F.aggregate("_responses", F.lit(0), lambda n, r: n + r["calls"])
    return (asked.withColumn("_best", best_of_responses("_responses"))
            .select(*df.columns, F.col("_best.question").alias("question"), F.col("_best.answer").alias("answer"),
                    counted.alias("calls"), (counted - F.size("_responses")).alias("retries")))


def best_of_rounds(rounds: DataFrame, *keys: str, response: str = "response", number: str = "round") -> DataFrame:
    """The same for a table with one row per round: grouped by ``keys``."""
    pair = parse_qa(response)
    length = F.length(pair["question"]) + F.length(pair["answer"])
    rank = F.when(length > 0, F.struct(length, -F.col(number)))
    best = F.max_by(F.when(length > 0, pair), rank)
    return rounds.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.coalesce(F.col("_best.question"), F.lit("")).alias("question"),
        F.coalesce(F.col("_best.answer"), F.lit("")).alias("answer"))


def run_model_test(dataset: DataFrame, fn: Callable[[list[dict]], Sequence[str]], model_name: str,
                   retries: int = 2, delay: float = 1.0, workers: int = 1, batch: int = BATCH, store: str | None = None) -> DataFrame:
    """Run a dataset through a model: + ``model_output, workflow_name, timestamp``.

    The dataset needs ``input``; ``fn`` gets dicts ``{query, inputs}`` and returns
    JSON responses. A row that fails keeps the error as its output.
    """
    if "input" not in dataset.columns:
        raise ValueError(f"the dataset has no 'input' column; it has {dataset.columns}")
    others = [c for c in dataset.columns if c != "input"]
    inputs = F.to_json(F.struct(*[F.col(f"`{c}`") for c in others])) if others else F.lit("{}")
    request = F.to_json(F.struct(F.col("input").cast("string").alias("query"), inputs.alias("inputs")))

    def ask(requests: list[str]) -> list[str]:
        import json
        decoded = [json.loads(r) for r in requests]
        for d in decoded:
            d["inputs"] = json.loads(d["inputs"])
        return list(fn(decoded))

    called = call_model(dataset.withColumn("_request", request), "_request", ask, "_r", 1, retries, delay, 1.0, workers, batch, store)
    one = F.get("_r", F.lit(0))
    output = F.when(one["error"].isNotNull(), F.concat(F.lit(TEST_FAILED), one["error"])).otherwise(
        extract_answer(one["response"]))
    return called.select(*dataset.columns, output.alias("model_output"), F.lit(model_name).alias("workflow_name"),
                         F.current_timestamp().alias("timestamp"))


def judge(results: DataFrame, rule: Mapping, fn: Model, retries: int = 0, delay: float = 1.0,
          workers: int = 1, batch: int = BATCH, store: str | None = None) -> DataFrame:
    """Score model outputs with a rule: + ``evaluation_score, _reason, _rule, _timestamp``.

    ``rule`` is ``{evaluation_rule: {name, prompt: {role: {description}}}}``.
    """
    body = rule.get("evaluation_rule")
    if body is None or "prompt" not in body:
        raise ValueError("the rule lacks 'evaluation_rule' or its 'prompt'")
    asked = results.withColumn("_prompt", render_prompt(results, body["prompt"]["role"]["description"]))
    called = call_model(asked, "_prompt", fn, "_r", 1, retries, delay, workers=workers, batch=batch, store=store)
    one = F.get("_r", F.lit(0))
    failed = F.struct(F.lit(0.0).alias("score"), F.concat(F.lit(JUDGE_FAILED), one["error"]).alias("reason"))
    verdict = F.when(one["error"].isNotNull(), failed).otherwise(parse_judgement(one["response"]))
    return called.withColumn("_v", verdict).select(
        *results.columns, F.col("_v.score").alias("evaluation_score"), F.col("_v.reason").alias("evaluation_reason"),
        F.lit(body["name"]).alias("evaluation_rule"), F.current_timestamp().alias("evaluation_timestamp"))
