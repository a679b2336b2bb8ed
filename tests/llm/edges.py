"""Awkward tables that every operator has to take, and small helpers."""

from pyspark.sql import functions as F, types as T

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} of{i % 31}." for i in range(30_000))
#: Names that operators use inside.
CLASHES = ("score", "spans", "key", "bytes", "root", "node", "n", "range", "head", "fp", "words", "seeds", "masked_text", "rank",
           "task", "text_key", "own_id", "hit", "at", "predicted")


def docs(spark, rows=None):
    """``doc_id, text, lang, source, n_chars`` and clashing extra columns."""
    if rows is None:
        rows = [(1, "The same text twice. Call +1 (212) 555-0100 now."), (1, "The same text twice. Call +1 (212) 555-0100 now."), (2, None),
                (3, ""), (None, "no id here"), (None, None), (4, LONG), (5, LONG + " end"), (6, "   \n\n "), (7, "1234 5678"), (8, "é" * 500)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    df = spark.createDataFrame([(i, t, None if i == 3 else "en", "s", len(t or "")) for i, t in rows], schema)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("x"))
    return df


def labels(spark, rows=((1, 1), (3, 0), (None, 1), (4, None))):
    return spark.createDataFrame(list(rows), "doc_id long, toxic int")


def items(spark, rows=((1, "a b c"), (2, None), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def rows_of(df, key=0):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
