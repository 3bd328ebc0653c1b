"""The training-data pipeline: quality rules, near duplicates, decontamination, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  A stage's result is
written as Parquet to the shared checkpoint folder and read again, so a lost
executor costs at most one stage.

An empty table gives an empty result; null texts, repeated rows, ties, very long
texts and further columns (kept as they are, whatever their names, up to the last
stage) are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontamination, near_duplicates, packing, pii, quality
from tillroll.llm.common import bound_batches, find_package, materialize, read_table
from tillroll.llm.queries import vocabulary


def _ready(spark: SparkSession) -> None:
    """The stages follow each other in the same executors and workers: batches of texts or sets are kept small, and
    workers allocate so that what they free goes back to the system."""
    find_package(spark)
    bound_batches(spark)
    for name, value in (("ARROW_DEFAULT_MEMORY_POOL", "system"), ("MALLOC_ARENA_MAX", "2")):
        spark.sparkContext.environment.setdefault(name, value)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    _ready(spark)
    return quality.keep_good(docs)


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    _ready(spark)
    return near_duplicates.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    _ready(spark)
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in it is replaced by its kind."""
    _ready(spark)
    return pii.redact_docs(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens with the sources' proportions in each."""
    _ready(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicate_documents),
          ("benchmark decontamination", benchmark_passages), ("personal data", personal_data), ("packing", pack)]

#: Packing depends on a tokenizer, which SQL has not: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the filters keep."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name.replace(' ', '_')}")
    return STAGES[-1][1](spark, docs, sf_dir)
