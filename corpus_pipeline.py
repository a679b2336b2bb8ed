"""documents -> toxicity -> near-duplicates -> decontamination -> personal data -> packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; the result is written as Parquet and read again for the next one.

Every stage takes null, empty and very long texts, null and repeated ids, repeated
rows, empty tables and other columns; what it does with them is said where its
operator is: ``drop_toxic``, ``drop_near_duplicates``, ``drop_contaminated``,
``mask_pii`` and ``pack_documents``. All but the last return the columns they got.
"""

from lorefield.llm.common import read, stored
from lorefield.llm.decontaminate import drop_contaminated
from lorefield.llm.packing import pack_documents
from lorefield.llm.pii import mask_pii
from lorefield.llm.queries import tokenizer_path
from lorefield.llm.simhash import drop_near_duplicates
from lorefield.llm.toxicity import drop_toxic


#: Rows of an Arrow batch: texts can be long, and every task holds a batch on both sides.
BATCH_ROWS = "1000"


def toxicity(spark, docs, sf_dir):
    """Rows that the toxicity model rejects go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One row of each group of equal or similar texts stays."""
    return drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Rows that overlap a benchmark item go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """Personal data is masked in the texts."""
    return mask_pii(docs)


def packing(spark, docs, sf_dir):
    """Pieces of the remaining texts and their places in sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packing)]

#: Trained models and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
