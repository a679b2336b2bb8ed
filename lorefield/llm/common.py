"""Small helpers shared by the operators of this package."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorefield.session import scratch_path

#: A table is broadcast only when its measured size stays below this many bytes.
BROADCAST_BYTES = 8 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as written to the shared folder: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table of fixed-size rows, marked for broadcast when its counted rows stay below ``most`` bytes."""
    return F.broadcast(df) if df.count() * row_bytes <= most else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def same(a: Column, b: Column) -> Column:
    """Equality for joins in which two nulls are equal."""
    return a.eqNullSafe(b)


def fold_of(doc_id: str, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def turn_of(seed: int, *columns: str) -> Column:
    """A number in [0, 1) from a hash of the columns, so that draws are the same however a table is laid out."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") / F.lit(float(1 << 53))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def batch_rows(batch, *names):
    """Columns of an Arrow batch as Python lists."""
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
