"""Model results that are paid for once.

Answers and vectors are kept in a store, a folder that all executors reach, by
the digest of the text that was asked. A run asks only for texts the store does
not know. Answers are written by a Python data source: every list of prompts is
a file of its own as soon as it is answered, so a lost executor or a failed job
costs the lists that were open, and the next run leaves out all others.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lorefield.session import scratch_path

ANSWERS = "prompt_id string, answers array<struct<response:string,error:string,calls:int>>"
_ENTRY = pa.struct([("response", pa.string()), ("error", pa.string()), ("calls", pa.int32())])
#: Texts that make up more than one row in this many are spread over SALTS tasks in a join.
HOT_SHARE = 1000
SALTS = 64


def text_id(column: str):
    """Digest by which a text is known; null counts as empty."""
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


# --- answers ----------------------------------------------------------------

@dataclass
class Asked(WriterCommitMessage):
    """What a task has asked for: prompts of new lists, and prompts of lists that an earlier attempt had written."""

    prompts: int
    found: int


class AnswerWriter(DataSourceArrowWriter):
    """Asks list by list; a list is a file named by its prompts, which is left alone if it is there."""

    def __init__(self, store: str, ask: Callable[[list[str]], list], batch: int, workers: int):
        self.store, self.ask, self.batch, self.workers = store, ask, batch, workers

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(self.store)
        files.create_dir(folder, recursive=True)

        def answer(rows: list[tuple[str, str]]) -> tuple[int, int]:
            ids = [i for i, _ in rows]
            name = f"{folder}/{hashlib.sha256(''.join(ids).encode()).hexdigest()}.parquet"
            if files.get_file_info(name).type == fs.FileType.File:
                return 0, len(rows)
            table = pa.table({"prompt_id": pa.array(ids, pa.string()), "answers": pa.array(self.ask([t for _, t in rows]), pa.list_(_ENTRY))})
            # Hidden until it is whole.
            part = f"{folder}/.{uuid.uuid4().hex}"
            with files.open_output_stream(part) as out:
                pq.write_table(table, out)
            files.move(part, name)
            return len(rows), 0

        def lists() -> Iterator[list[tuple[str, str]]]:
            held: list[tuple[str, str]] = []
            for b in iterator:
                held += zip(b.column("prompt_id").to_pylist(), b.column("prompt").to_pylist())
                while len(held) >= self.batch:
                    yield held[:self.batch]
                    del held[:self.batch]
            if held:
                yield held

        asked = found = 0
        with ThreadPoolExecutor(self.workers) as pool:
            # A list for every worker at a time, so that a task holds few prompts.
            waiting: list = []
            for rows in lists():
                waiting.append(pool.submit(answer, rows))
                if len(waiting) >= self.workers:
                    a, b = waiting.pop(0).result()
                    asked, found = asked + a, found + b
            for w in waiting:
                a, b = w.result()
                asked, found = asked + a, found + b
        return Asked(asked, found)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """The lists are in place already."""

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Lists that were answered stay: the next run leaves them out."""


def _source(store: str, ask: Callable[[list[str]], list], batch: int, workers: int) -> type[DataSource]:
    name_ = f"answers_{uuid.uuid4().hex}"

    class Answers(DataSource):
        @classmethod
        def name(cls) -> str:
            return name_

        def writer(self, schema, overwrite: bool) -> AnswerWriter:
            return AnswerWriter(store, ask, batch, workers)

    return Answers


def stored_answers(spark: SparkSession, store: str, rounds: int = 1) -> DataFrame:
    """``prompt_id, answers`` of the prompts that have ``rounds`` answers in the store."""
    parts = [f"{store}/{p}" for p in ("lists", "kept") if _exists(spark, f"{store}/{p}")]
    if not parts:
        return spark.createDataFrame([], ANSWERS)
    rows = spark.read.schema(ANSWERS).parquet(*parts).where(F.size("answers") >= rounds)
    # A prompt can be there twice after a crash between the two steps of compacting, or with fewer rounds.
    return rows.groupBy("prompt_id").agg(F.max_by("answers", F.size("answers")).alias("answers")).select(
        "prompt_id", F.slice("answers", 1, rounds).alias("answers"))


def answer_once(df: DataFrame, prompt: str, ask: Callable[[list[str]], list], store: str, out: str, rounds: int, batch: int, workers: int) -> DataFrame:
    """``df`` with the stored answers of its prompts, after asking for those that are missing.

    ``ask`` gets a list of prompts and returns a list of round entries for each.
    Equal prompts are asked once. The prompts are computed twice, so they must be
    the same each time.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_prompt_id", text_id(prompt))
    wanted = keyed.select(F.col("_prompt_id").alias("prompt_id"), F.coalesce(F.col(prompt), F.lit("")).alias("prompt")).dropDuplicates(["prompt_id"])
    pending = scratch_path(spark, "prompts")
    # Stored in order: another attempt of a task cuts the same lists.
    (wanted.join(stored_answers(spark, store, rounds), "prompt_id", "left_anti")
     .repartition("prompt_id").sortWithinPartitions("prompt_id").write.parquet(pending))
    missing = spark.read.schema("prompt_id string, prompt string").parquet(pending)
    if not missing.isEmpty():
        source = _source(f"{store}/lists", ask, batch, workers)
        spark.dataSource.register(source)
        missing.write.format(source.name()).mode("append").save()
    known = stored_answers(spark, store, rounds).select(F.col("prompt_id").alias("_prompt_id"), F.col("answers").alias(out))
    return spread_join(keyed, known, "_prompt_id").drop("_prompt_id")


def compact_answers(spark: SparkSession, store: str) -> None:
    """Few large files instead of one per list; not while a run is writing."""
    if not _exists(spark, f"{store}/lists"):
        return
    lists = spark.read.schema(ANSWERS).parquet(f"{store}/lists")
    names = lists.inputFiles()
    lists.coalesce(max(1, len(names) // 1000)).write.mode("append").parquet(f"{store}/kept")
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


# --- vectors ----------------------------------------------------------------

def embed_once(df: DataFrame, col: str, encode: Callable[[DataFrame, str], DataFrame], store: str, out: str = "embedding") -> DataFrame:
    """``df`` with the stored vectors of a text column, after encoding the texts the store does not know.

    ``encode`` adds an ``array<float>`` column ``embedding`` to a table for a text
    column. Equal texts are encoded once, in this run and over runs with the same
    store; use a store for each model. The texts are computed twice.
    """
    spark, folder = df.sparkSession, f"{store}/vectors"
    keyed = df.withColumn("_text_id", text_id(col))
    wanted = keyed.select(F.col("_text_id").alias("text_id"), F.coalesce(F.col(col), F.lit("")).alias("text")).dropDuplicates(["text_id"])
    fields = "text_id string, embedding array<float>"
    if _exists(spark, folder):
        wanted = wanted.join(spark.read.schema(fields).parquet(folder).select("text_id"), "text_id", "left_anti")
    # Stored before the model runs, so that the model runs once per text.
    pending = scratch_path(spark, "texts")
    wanted.write.parquet(pending)
    fresh = spark.read.schema("text_id string, text string").parquet(pending)
    if not fresh.isEmpty():
        encode(fresh, "text").select("text_id", F.col("embedding").cast("array<float>")).write.mode("append").parquet(folder)
    elif not _exists(spark, folder):
        spark.createDataFrame([], fields).write.parquet(folder)
    known = spark.read.schema(fields).parquet(folder).select(F.col("text_id").alias("_text_id"), F.col("embedding").alias(out))
    return spread_join(keyed, known, "_text_id").drop("_text_id")


def spread_join(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Inner join of many rows with one row per key, in which very frequent keys meet in many tasks.

    Keys of more than one row in ``HOT_SHARE`` are counted first: there are fewer
    than ``HOT_SHARE`` of them. Their rows are dealt over ``SALTS`` tasks, and
    their one row of ``known`` goes to each.
    """
    total = rows.count()
    hot = [r[key] for r in rows.groupBy(key).count().where(F.col("count") > max(total // HOT_SHARE, 10_000)).select(key).collect()]
    if not hot:
        return rows.join(known, key)
    names = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot], "_hot string"))
    turn = F.when(F.col("_hot").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    dealt = rows.join(names, F.col(key) == F.col("_hot"), "left").withColumn("_turn", turn).drop("_hot")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = known.join(names, F.col(key) == F.col("_hot"), "left").withColumn("_turn", F.explode(copies)).drop("_hot")
    return dealt.join(spread, [key, "_turn"]).drop("_turn")
