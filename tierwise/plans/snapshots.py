"""Version tables of movies and genres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tierwise.operators.history import snapshot

PREFIX = "dbt_"
MOVIE_COLUMNS = (
    "movie_id", "title", "status", "budget_usd", "revenue_usd", "profit_usd", "roi_pct",
    "vote_average", "vote_count", "popularity_score", "runtime_minutes", "original_language",
    "release_date", "release_year", "release_month", "release_season", "_source_ingested_at",
    "_source_batch_id", "_silver_loaded_at",
)
MOVIE_CHECKS = (
    "budget_usd", "revenue_usd", "vote_average", "popularity_score", "status", "runtime_minutes",
)
GENRE_COLUMNS = (
    "genre_sk", "genre_id", "genre_name", "genre_group", "is_blockbuster_genre",
    "_silver_loaded_at", "_gold_loaded_at",
)
GENRE_CHECKS = ("genre_name", "genre_group", "is_blockbuster_genre")


def snap_silver_movies(history: DataFrame | None, movies: DataFrame, as_of: Column) -> DataFrame:
    return snapshot(
        history, movies.select(*MOVIE_COLUMNS), "movie_id", MOVIE_CHECKS, as_of, prefix=PREFIX
    )


def snap_dim_genres(history: DataFrame | None, genres: DataFrame, as_of: Column) -> DataFrame:
    return snapshot(
        history, genres.select(*GENRE_COLUMNS), "genre_id", GENRE_CHECKS, as_of, prefix=PREFIX
    )


#: Key, checked columns and stored columns of each version table.
TABLES = {
    "snap_silver_movies": ("movie_id", MOVIE_CHECKS, MOVIE_COLUMNS),
    "snap_dim_genres": ("genre_id", GENRE_CHECKS, GENRE_COLUMNS),
}
