"""Gold: dimensions and the movie fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.functions.cleaning import compare_flag, map_labels, or_unknown
from tierwise.functions.keys import surrogate_key
from tierwise.operators.calendar import date_dimension
from tierwise.operators.dedup import lowest_child
from tierwise.operators.joins import lookup, range_lookup
from tierwise.sources.seeds import read_seed
from tierwise.plans.reference_data import (
    BLOCKBUSTER_GENRES, BUDGET_TIER_SCHEMA, BUDGET_TIERS, CALENDAR_END, CALENDAR_START,
    GENRE_GROUPS, OTHER, REGIONS, STUDIO_TIERS, UNKNOWN, UNKNOWN_DATE_KEY,
)

FACT_COLUMNS = (
    "movie_sk", "date_sk", "genre_sk", "company_sk", "movie_id", "primary_genre_id",
    "primary_company_id", "title", "original_language", "status", "release_year", "release_month",
    "release_season", "imdb_id", "budget_usd", "revenue_usd", "profit_usd", "roi_pct",
    "runtime_minutes", "popularity_score", "vote_average", "vote_count", "profitability_flag",
    "budget_tier", "_source_ingested_at", "_gold_loaded_at",
)


def budget_tiers(spark: SparkSession, seeds: str | None = None) -> DataFrame:
    """The tiers in ``budget_tiers.csv`` of the seed folder, or the fixed ones."""
    if seeds is not None:
        return read_seed(spark, f"{seeds.rstrip('/')}/budget_tiers.csv", BUDGET_TIER_SCHEMA)
    return spark.createDataFrame(BUDGET_TIERS, BUDGET_TIER_SCHEMA)


def _with_unknown(dimension: DataFrame, key: str, wanted: bool) -> DataFrame:
    """With the member that unmatched facts point to: an UNKNOWN key, all else NULL."""
    if not wanted:
        return dimension
    unknown = dimension.sparkSession.range(1).select(F.lit(UNKNOWN).alias(key))
    return dimension.unionByName(unknown, allowMissingColumns=True)


def dim_dates(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    unknown_member: bool = False,
) -> DataFrame:
    return date_dimension(spark, start, end, unknown_member)


def dim_genres(genres: DataFrame, loaded_at: Column, unknown_member: bool = False) -> DataFrame:
    name = F.col("genre_name")
    dimension = genres.select(
        surrogate_key(F.col("genre_id")).alias("genre_sk"),
        "genre_id",
        "genre_name",
        map_labels(name, GENRE_GROUPS, OTHER).alias("genre_group"),
        F.coalesce(name.isin(*BLOCKBUSTER_GENRES), F.lit(False)).alias("is_blockbuster_genre"),
        "_silver_loaded_at",
        loaded_at.alias("_gold_loaded_at"),
    )
    return _with_unknown(dimension, "genre_sk", unknown_member)


def dim_production_companies(companies: DataFrame, loaded_at: Column, unknown_member: bool = False) -> DataFrame:
    country = F.col("origin_country")
    dimension = companies.select(
        surrogate_key(F.col("company_id")).alias("company_sk"),
        "company_id",
        "company_name",
        or_unknown(country, UNKNOWN).alias("origin_country"),
        map_labels(country, REGIONS, OTHER).alias("region"),
        map_labels(F.col("company_name"), STUDIO_TIERS, UNKNOWN).alias("studio_tier"),
        "_silver_loaded_at",
        loaded_at.alias("_gold_loaded_at"),
    )
    return _with_unknown(dimension, "company_sk", unknown_member)


def fact_movies(
    movies: DataFrame,
    movie_genres: DataFrame,
    movie_companies: DataFrame,
    dates: DataFrame,
    genres: DataFrame,
    companies: DataFrame,
    tiers: DataFrame,
    loaded_at: Column,
) -> DataFrame:
    """One row per released movie.

    The status filter runs before the joins; it reads one movie column, so the result is the same.
    Movies, primary genres and primary companies meet on ``movie_id`` and share one partitioning.
    """
    released = movies.filter((F.col("status") == "Released") | F.col("status").isNull())
    primary_genre = lowest_child(movie_genres, "movie_id", "genre_id")
    primary_company = movie_companies.filter("is_primary_company").select("movie_id", "company_id")

    by_movie = {"movie_id": "movie_id"}
    fact = lookup(released, primary_genre, by_movie, {"primary_genre_id": "genre_id"})
    fact = lookup(fact, primary_company, by_movie, {"primary_company_id": "company_id"})
    fact = lookup(
        fact, dates, {"release_date": "full_date"}, {"date_sk": "date_sk"},
        {"date_sk": UNKNOWN_DATE_KEY},
    )
    fact = lookup(
        fact, genres, {"primary_genre_id": "genre_id"}, {"genre_sk": "genre_sk"},
        {"genre_sk": UNKNOWN},
    )
    # Companies grow with the data and one of them, or none, may hold a large share of the movies.
    fact = lookup(
        fact, companies, {"primary_company_id": "company_id"}, {"company_sk": "company_sk"},
        {"company_sk": UNKNOWN}, spread_by=["movie_id"],
    )
    fact = range_lookup(
        fact, "budget_usd", tiers, "min_budget_usd", "max_budget_usd", {"budget_tier": "tier_name"}
    )
    known = F.col("budget_usd").isNotNull() & F.col("revenue_usd").isNotNull()
    return fact.withColumns(
        {
            "movie_sk": surrogate_key(F.col("movie_id")),
            "profitability_flag": F.when(
                known, compare_flag(F.col("revenue_usd"), F.col("budget_usd"))
            ).otherwise(UNKNOWN),
            "_gold_loaded_at": loaded_at,
        }
    ).select(*FACT_COLUMNS)
