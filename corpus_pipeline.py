"""The corpus pipeline: five stages, each one operator of ``kindred.llm``.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns the documents that go on (columns of ``documents``; the
last stage returns a row per document of the written token files).  Each result
is written as Parquet and reread as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import decontaminate, minhash, mixing, token_codes, toxicity
from kindred.llm.common import materialize
from kindred.llm.registry import table, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (shingles of five words) stays:
    its smallest id (of repeated rows with that id and set, one by text)."""
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows cover by a twentieth or more go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies by epoch, then the fractional selection."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: a row per document."""
    return token_codes.token_codes(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: Training a classifier and merging tokens cannot be stated in SQL; the tests
#: compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
