"""Five stages from raw documents to a mix: each stage works on all rows that the one before kept.

Every stage takes (spark, docs, sf_dir), returns a DataFrame, and is written below the shared folder before the next one
reads it. All but the last return the columns of ``documents``; the last returns one row per kept document with the words
that the mix takes of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from tierwise.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, learnt from the labels of these documents, does not reject."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten of them have; ``n_chars`` is counted anew."""
    done = line_dedup.drop_frequent_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns])
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Size, target of the source and words taken, of every document left."""
    return mixing.mix(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_duplicates),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

#: The classifier, the fingerprints and the banded alignment have no SQL form; the tests hold them against plain ones.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
