"""The training-data pipeline: quality, near-duplicates, benchmark leaks, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next stage's ``docs``. All but the last return the columns of
``documents``. No rows give no rows; how a stage treats nulls, empty texts, ties and
repeated rows is said where its operator is defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import decontaminate, mix, neardup, pii, quality
from tollgate.session import stored

#: Documents that score less are left out.
LEAST_QUALITY = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier, trained on the labelled ones, finds good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(quality.remainder(3) != 1)
    model = quality.train(quality.measured(docs), labels)
    return quality.accepted(docs, model, LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one of the smallest doc_id."""
    return neardup.deduplicated(docs, size=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    return pii.masked(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: a row for each copy, with copy, shard and position."""
    return mix.mixture(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("personal data", personal_data),
    ("source mixing", mixed_sources),
]

#: SQL can express neither the trained stages nor the random mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
