"""Silver: typed movies, entities and bridges taken out of the raw documents.

The functions take the part of bronze to process, all of it or a recent window; merging into the
stored table is the caller's (:mod:`tierwise.plans.warehouse`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.functions.cleaning import blank_to_null, standard_upper, variant_field, zero_to_null
from tierwise.functions.dates import release_season, safe_date
from tierwise.functions.measures import difference_if_known, return_pct
from tierwise.operators.dedup import drop_null_keys, keep_latest, latest_row
from tierwise.operators.nested import explode_array
from tierwise.plans.reference_data import DATA_SOURCE

TEXT_FIELDS = (
    "title", "original_title", "tagline", "overview", "status", "homepage", "imdb_id",
    "original_language",
)
MOVIE_COLUMNS = (
    "movie_id", *TEXT_FIELDS, "release_date", "release_year", "release_month", "release_quarter",
    "release_season", "budget_usd", "revenue_usd", "runtime_minutes", "popularity_score",
    "vote_average", "vote_count", "is_adult_content", "profit_usd", "roi_pct",
    "_source_ingested_at", "_source_batch_id", "_silver_loaded_at", "_data_source",
)


def silver_movies(bronze: DataFrame, loaded_at: Column) -> DataFrame:
    doc = F.col("raw_data")
    known = {
        "budget_usd": ("$.budget", "bigint"),
        "revenue_usd": ("$.revenue", "bigint"),
        "runtime_minutes": ("$.runtime", "bigint"),
        "vote_count": ("$.vote_count", "bigint"),
    }
    parsed = bronze.select(
        variant_field(doc, "$.id", "bigint").alias("movie_id"),
        *[blank_to_null(variant_field(doc, f"$.{f}", "string")).alias(f) for f in TEXT_FIELDS],
        safe_date(variant_field(doc, "$.release_date", "string"), "yyyy-MM-dd").alias("release_date"),
        *[zero_to_null(variant_field(doc, p, t)).alias(name) for name, (p, t) in known.items()],
        variant_field(doc, "$.popularity", "double").alias("popularity_score"),
        variant_field(doc, "$.vote_average", "double").alias("vote_average"),
        variant_field(doc, "$.adult", "boolean").alias("is_adult_content"),
        F.col("ingested_at").alias("_source_ingested_at"),
        F.col("batch_id").alias("_source_batch_id"),
    )
    date, budget, revenue = F.col("release_date"), F.col("budget_usd"), F.col("revenue_usd")
    movies = parsed.withColumns(
        {
            "release_year": F.year(date),
            "release_month": F.month(date),
            "release_quarter": F.quarter(date),
            "release_season": release_season(F.month(date)),
            "profit_usd": difference_if_known(revenue, budget),
            "roi_pct": return_pct(revenue, budget),
            "_silver_loaded_at": loaded_at,
            "_data_source": F.lit(DATA_SOURCE),
        }
    )
    return drop_null_keys(movies, ["movie_id"]).select(*MOVIE_COLUMNS)


def silver_genres(raw_genres: DataFrame, loaded_at: Column) -> DataFrame:
    """The newest reference list, one row per genre."""
    newest = latest_row(raw_genres, "ingested_at", ["batch_id"])
    fields = {"genre_id": ("id", "bigint"), "genre_name": ("name", "string")}
    genres = drop_null_keys(explode_array(newest, "raw_data", "$", fields), ["genre_id"])
    return genres.select(
        "genre_id",
        standard_upper(F.col("genre_name")).alias("genre_name"),
        loaded_at.alias("_silver_loaded_at"),
    )


def silver_movie_genres(bronze: DataFrame, loaded_at: Column) -> DataFrame:
    """One row per movie and genre. Bronze is unique by movie, so this needs no shuffle."""
    fields = {"genre_id": ("id", "bigint"), "genre_name_raw": ("name", "string")}
    rows = explode_array(
        bronze, "raw_data", "$.genres", fields, keep=["movie_id", "ingested_at"], once_per="genre_id"
    )
    return drop_null_keys(rows, ["movie_id", "genre_id"]).select(
        "movie_id", "genre_id", "genre_name_raw", "ingested_at", loaded_at.alias("_silver_loaded_at")
    )


COMPANY_FIELDS = {
    "company_id": ("id", "bigint"),
    "company_name": ("name", "string"),
    "origin_country": ("origin_country", "string"),
}


def silver_production_companies(bronze: DataFrame, loaded_at: Column) -> DataFrame:
    """One row per company: its name and country as sent last, at its first place in a document."""
    rows = explode_array(
        bronze, "raw_data", "$.production_companies", COMPANY_FIELDS,
        keep=["movie_id", "ingested_at"], position="at",
    ).withColumns(
        {
            "company_name": F.trim("company_name"),
            "origin_country": F.nullif(standard_upper(F.col("origin_country")), F.lit("")),
        }
    )
    known = drop_null_keys(rows, ["company_id", "company_name"])
    newest = keep_latest(known, ["company_id"], "ingested_at", ["movie_id", -F.col("at")])
    return newest.select(
        "company_id", "company_name", "origin_country", "ingested_at",
        loaded_at.alias("_silver_loaded_at"),
    )


def silver_movie_companies(bronze: DataFrame, loaded_at: Column) -> DataFrame:
    """One row per movie and company with the company's position; position 0 is primary.

    A company listed twice keeps its first position, as the key is (movie, company).
    """
    rows = explode_array(
        bronze, "raw_data", "$.production_companies", COMPANY_FIELDS,
        keep=["movie_id", "ingested_at"], position="company_position", once_per="company_id",
    )
    return drop_null_keys(rows, ["movie_id", "company_id"]).select(
        "movie_id",
        "company_id",
        F.trim("company_name").alias("company_name"),
        "company_position",
        (F.col("company_position") == 0).alias("is_primary_company"),
        "ingested_at",
        loaded_at.alias("_silver_loaded_at"),
    )
