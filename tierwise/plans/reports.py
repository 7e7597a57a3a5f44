"""Analyst reads on the built tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierwise.functions.measures import PERCENT, rounded_mean
from tierwise.operators.joins import lookup


def top_by_revenue(top_movies: DataFrame, k: int = 10) -> DataFrame:
    """The movies on the first ``k`` revenue ranks, ties included."""
    return (
        top_movies.filter(F.col("revenue_rank_all_time") <= k)
        .select("title", "release_year", (F.col("revenue_usd") / F.lit(1000000)).alias("revenue_millions"), "vote_average", "revenue_rank_all_time")
        .orderBy("revenue_rank_all_time")
    )


def genres_by_roi(genre_performance: DataFrame, k: int = 10) -> DataFrame:
    return (
        genre_performance.select("genre_name", "total_movies", "avg_revenue_millions", "avg_roi_pct", "roi_rank")
        .orderBy(F.col("avg_roi_pct").desc_nulls_last(), "genre_name")
        .limit(k)
    )


def trends_since(yearly_trends: DataFrame, year: int = 2000) -> DataFrame:
    return (
        yearly_trends.filter(F.col("release_year") >= year)
        .select("release_year", "total_movies_released", "avg_budget_millions", "avg_revenue_millions",
                "yoy_budget_change_millions", "avg_rating")
        .orderBy("release_year")
    )


def genre_top_roi(fact: DataFrame, genres: DataFrame, genre: str = "ACTION", k: int = 20) -> DataFrame:
    """The ``k`` movies of one genre with the highest return."""
    wanted = genres.filter(F.col("genre_name") == genre)
    rows = lookup(
        fact.filter("roi_pct is not null"), wanted, {"genre_sk": "genre_sk"},
        {"genre_name": "genre_name"}, how="inner",
    )
    return (
        rows.select(
            "movie_id", "title", "release_year",
            (F.col("budget_usd") / F.lit(1e6)).alias("budget_m"),
            (F.col("revenue_usd") / F.lit(1e6)).alias("revenue_m"), "roi_pct",
        )
        .orderBy(F.col("roi_pct").desc_nulls_last(), "movie_id")
        .limit(k)
    )


def profitability_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("profitability_flag").agg(F.count(F.lit(1)).alias("n_movies"))


def season_roi(fact: DataFrame) -> DataFrame:
    return fact.groupBy("release_season").agg(
        rounded_mean(F.col("roi_pct"), 2, dtype=PERCENT).alias("avg_roi_pct")
    )


def studio_output(fact: DataFrame, companies: DataFrame) -> DataFrame:
    """Movies per company and year. Counted per key before the join, so no studio is a hot key."""
    counted = (
        fact.filter("release_year is not null")
        .groupBy("company_sk", "release_year")
        .agg(F.count(F.lit(1)).alias("n_movies"))
    )
    named = lookup(
        counted, companies, {"company_sk": "company_sk"}, {"company_name": "company_name"}, how="inner"
    )
    return named.select("company_name", "release_year", "n_movies")
