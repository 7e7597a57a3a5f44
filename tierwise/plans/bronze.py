"""Bronze: the newest raw document per movie."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierwise.functions.keys import document_hash
from tierwise.sources.documents import newest_documents


ROW_HASH = "row_hash"


def with_hash(documents: DataFrame) -> DataFrame:
    """Documents with their hash, worked out for those that were not loaded with one."""
    made = document_hash(F.col("raw_data"))
    return documents.withColumn(ROW_HASH, F.coalesce(ROW_HASH, made) if ROW_HASH in documents.columns else made)


def bronze_movies_raw(raw: DataFrame) -> DataFrame:
    """Documents of one movie in one batch are told apart by their hash, so the pick repeats."""
    return with_hash(newest_documents(raw)).select(
        "movie_id",
        "raw_data",
        "source_url",
        "ingested_at",
        F.col("ingested_at").cast("date").alias("ingestion_date"),
        "batch_id",
        ROW_HASH,
    )
