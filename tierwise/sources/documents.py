"""Landing JSON documents as key + VARIANT + lineage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.functions.dates import moment
from tierwise.functions.keys import document_hash
from tierwise.operators.dedup import keep_first, keep_latest
from tierwise.operators.merge import merge_upsert, repeated_key
from tierwise.sources.shared_folder import cut_lineage


def stamp_batch(
    df: DataFrame, batch_id: str, ingested_at: dt.datetime, source_url: str | Column | None = None
) -> DataFrame:
    """Add the lineage columns that all rows of one run share."""
    url = source_url if isinstance(source_url, Column) else F.lit(source_url).cast("string")
    return df.withColumns(
        {
            "source_url": url,
            "ingested_at": moment(ingested_at),
            "batch_id": F.lit(batch_id),
        }
    )


def parse_documents(
    lines: DataFrame, text: str = "value", key: str = "movie_id", path: str = "$.id"
) -> tuple[DataFrame, DataFrame]:
    """Split lines of JSON text into documents and rejects.

    Documents are ``key, raw_data``. Rejects are malformed text (a repeated object key counts as
    malformed) and documents without a usable id, with the reason; only blank lines are dropped.
    """
    # Parsing is the costly step. A filter on a plain projection would be pushed below it and parse
    # every line twice; it is not pushed below a generator.
    document = F.struct(F.try_parse_json(text).alias("raw_data"))
    once = F.inline(F.when(F.trim(text) != "", F.array(document)))
    parsed = lines.select(F.col(text).alias("text"), once)
    number = F.try_variant_get("raw_data", path, "decimal(38,0)").cast("bigint")
    parsed = parsed.withColumn(key, F.nullif(number, F.lit(0).cast("bigint")))
    documents = parsed.filter(F.col(key).isNotNull()).select(key, "raw_data")
    reason = F.when(F.col("raw_data").isNull(), "malformed").otherwise("no id")
    rejects = parsed.filter(F.col(key).isNull()).select("text", reason.alias("reason"))
    return documents, rejects


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON files with one document per line; such files split over tasks at any size."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths))


def read_array_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON files that each hold one array, as one line of text per array element.

    A malformed file, or one that holds no array, comes back whole as one line, which parsing then rejects. A file is read
    by one task, so keep such files small or write documents one per line.
    """
    files = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    # Parsed once, below a generator; see parse_documents.
    parsed = files.select("value", F.inline(F.array(F.struct(F.try_parse_json("value").alias("doc")))))
    is_array = F.col("doc").isNotNull() & F.schema_of_variant("doc").startswith("ARRAY")
    arrays = parsed.select("value", F.when(is_array, F.col("doc")).alias("doc"))
    elements = spark.tvf.variant_explode_outer(F.col("doc").outer()).select(F.col("value").alias("element"))
    exploded = arrays.lateralJoin(elements)
    no_array = F.to_json(F.struct(F.lit("the file holds no array").alias("error"), F.col("value").alias("file")))
    rejected = F.when(F.try_parse_json("value").isNull(), F.col("value")).otherwise(no_array)
    text = F.when(F.col("doc").isNull(), rejected).otherwise(F.to_json("element"))
    return exploded.select(text.alias("value")).filter("value is not null")


def newest_documents(documents: DataFrame, key: str = "movie_id") -> DataFrame:
    """The newest document per key; of several in one batch the one with the highest hash.

    Documents are wide and their hash costs more than parsing them, so whether any key repeats is asked first: documents
    meet only if one does, and are hashed only if it does so within a batch. Keys are read up to three times; pass rows that
    are written out.
    """
    if not repeated_key(documents, [key]):
        return documents
    ties = ["batch_id"]
    if repeated_key(documents, [key, "ingested_at", "batch_id"]):
        ties.append(document_hash(F.col("raw_data")))
    return keep_latest(documents, [key], "ingested_at", ties)


def land_upsert(target: DataFrame | None, documents: DataFrame, key: str = "movie_id") -> DataFrame:
    """Raw table after one load: the newest document per key wins, of several the one with the highest hash."""
    newest = newest_documents(cut_lineage(documents), key)
    return newest if target is None else merge_upsert(target, newest, [key])


def land_snapshot(
    spark: SparkSession, array_text: str, batch_id: str, ingested_at: dt.datetime
) -> DataFrame:
    """One row that holds a whole reference list as an array, to be appended to its raw table."""
    row = spark.range(1).select(F.parse_json(F.lit(array_text)).alias("raw_data"))
    return stamp_batch(row, batch_id, ingested_at).drop("source_url")


def distinct_listing(listing: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Listing rows without ids repeated on later pages."""
    return keep_first(listing.na.drop(subset=[key]), [key], order)
