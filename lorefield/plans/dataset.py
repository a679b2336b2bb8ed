"""From a corpus to a question-answer dataset, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lorefield.functions.answers import valid_qa
from lorefield.operators.chunking import chunk_documents
from lorefield.operators.generation import Model, generate
from lorefield.operators.states import pending_rows

# The text asked of the model for each chunk; {text} stands for the masked chunk.
PROMPT = ("Write one question that the following text answers, and answer it from the text alone.\n\n"
          "Text: {text}\n\n"
          "Reply in this form:\n- question: <question>\n- answer: <answer>\n")


def qa_prompt(template: str = PROMPT, text: str = "text_pure"):
    head, _, tail = template.partition("{text}")
    return F.concat(F.lit(head), F.coalesce(F.col(text), F.lit("")), F.lit(tail))


def corpus_to_qa(corpus: DataFrame, fn: Model, done: DataFrame | None = None, rounds: int = 3, retries: int = 3,
                 delay: float = 5.0, template: str = PROMPT, **chunking) -> DataFrame:
    """Chunks with question, answer and ``valid``; rows already in ``done`` are skipped."""
    chunks = chunk_documents(corpus, **chunking)
    if done is not None:
        chunks = pending_rows(chunks, done)
    # Chunks of one document are spread: a long document's model calls do not run one after another.
    chunks = chunks.repartition("file_name", "chunk_no")
    asked = generate(chunks.withColumn("_prompt", qa_prompt(template)), "_prompt", fn, rounds, retries, delay)
    return asked.drop("_prompt").withColumn("valid", valid_qa("question", "answer"))
