"""The corpus pipeline: language ID, near-dedup, decontamination, PII, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the scratch folder and read back as the next stage's docs. A stage
works on all rows its predecessor kept and judges them by themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brandflow.llm import language_ppm, mixing, near_fss, pii, positional_index
from brandflow.llm.scratch import written
from brandflow.llm.shipping import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; ``und`` and unreadable ones go."""
    ship_package(spark)
    return language_ppm.keep_identified(docs, language_ppm.fit_language_model(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    ship_package(spark)
    return near_fss.without_near_duplicates(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return positional_index.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    ship_package(spark)
    return pii.redact(docs, pii.fit_span_model(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, one or two rows each."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("near_dedup", deduplicated),
    ("decontamination", decontaminated),
    ("personal_data", redacted),
    ("mixing", mixed),
]

#: No SQL: the trained language model and the mixing weights are not SQL-expressible; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
