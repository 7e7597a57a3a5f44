"""The declared data checks of the warehouse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierwise.functions.dates import SEASON_MONTHS
from tierwise.operators.quality import Check
from tierwise.plans.reference_data import DATA_SOURCE

# Bounds and value sets of the checks, per table.
NOT_NULL = {
    "raw_movies": ("movie_id", "raw_data", "ingested_at"),
    "raw_genres": ("raw_data",),
    "bronze_movies_raw": ("movie_id", "raw_data", "ingested_at", "ingestion_date"),
    "silver_movies": ("movie_id", "title", "_data_source"),
    "silver_genres": ("genre_id", "genre_name"),
    "silver_movie_genres": ("movie_id", "genre_id"),
    "silver_production_companies": ("company_id", "company_name"),
    "silver_movie_companies": ("movie_id", "company_id"),
    "dim_dates": ("date_sk", "full_date", "release_season"),
    "dim_genres": ("genre_sk", "genre_id", "genre_name", "genre_group"),
    "dim_production_companies": ("company_sk", "company_id"),
    "fact_movies": ("movie_sk", "movie_id", "profitability_flag"),
    "kpi_genre_performance": ("genre_name", "genre_sk", "total_movies", "roi_rank", "revenue_rank"),
    "kpi_yearly_trends": ("release_year", "total_movies_released"),
    "kpi_top_movies": (
        "movie_sk", "movie_id", "title", "vote_average", "vote_count", "revenue_rank_all_time",
        "rating_decile", "revenue_decile",
    ),
}
UNIQUE = {
    "raw_movies": ("movie_id",),
    "bronze_movies_raw": ("movie_id",),
    "silver_movies": ("movie_id",),
    "silver_genres": ("genre_id", "genre_name"),
    "silver_production_companies": ("company_id",),
    "dim_dates": ("date_sk", "full_date"),
    "dim_genres": ("genre_sk", "genre_id", "genre_name"),
    "dim_production_companies": ("company_sk", "company_id"),
    "fact_movies": ("movie_sk", "movie_id"),
    "kpi_genre_performance": ("genre_name",),
    "kpi_yearly_trends": ("release_year",),
    "kpi_top_movies": ("movie_sk", "movie_id"),
}
RELATIONSHIPS = (
    ("silver_movie_genres", "movie_id", "silver_movies", "movie_id"),
    ("silver_movie_genres", "genre_id", "silver_genres", "genre_id"),
    ("fact_movies", "date_sk", "dim_dates", "date_sk"),
)
ACCEPTED = (
    ("silver_movies", "_data_source", (DATA_SOURCE,)),
    ("dim_dates", "release_season", tuple(SEASON_MONTHS)),
    ("dim_genres", "genre_group", ("HIGH_OCTANE", "NARRATIVE", "LIGHT", "NICHE", "ARTS", "OTHER")),
    ("dim_production_companies", "studio_tier", ("MAJOR_STUDIO", "MINI_MAJOR", "INDIE", "UNKNOWN")),
    ("dim_production_companies", "region", ("NORTH_AMERICA", "EUROPE", "ASIA_PACIFIC", "OTHER")),
    ("fact_movies", "profitability_flag", ("PROFITABLE", "BREAK_EVEN", "LOSS", "UNKNOWN")),
)
MOVIE_BOUNDS = (
    ("release_year", 1888, 2030),
    ("budget_usd", 0, 1_000_000_000),
    ("revenue_usd", 0, 5_000_000_000),
    ("runtime_minutes", 1, 600),
    ("vote_average", 0, 10),
    ("vote_count", 0, 10_000_000),
)
BETWEEN = {
    "silver_movies": (*MOVIE_BOUNDS, ("release_month", 1, 12)),
    "silver_movie_companies": (("company_position", 0, 50),),
    "dim_dates": (("calendar_year", 2000, 2030), ("calendar_month", 1, 12)),
    "fact_movies": MOVIE_BOUNDS,
    "kpi_genre_performance": (
        ("total_movies", 0, 100_000), ("avg_roi_pct", -100, 100_000), ("avg_rating", 0, 10),
        ("total_revenue_millions", 0, 1_000_000),
    ),
    "kpi_yearly_trends": (
        ("release_year", 1980, 2030), ("total_movies_released", 0, 50_000), ("avg_rating", 0, 10),
        ("avg_roi_pct", -100, 100_000),
    ),
    "kpi_top_movies": (
        ("vote_average", 0, 10), ("vote_count", 100, 10_000_000),
        ("revenue_rank_all_time", 1, 1_000_000), ("rating_decile", 1, 10),
        ("revenue_decile", 1, 10), ("revenue_percentile", 0.0, 1.0), ("rating_percentile", 0.0, 1.0),
    ),
}
ROW_COUNTS = (
    ("silver_movies", 1, 1_000_000),
    ("silver_genres", 10, 30),
    ("dim_dates", 10_000, 15_000),
    ("dim_genres", 10, 30),
    ("fact_movies", 1, 1_000_000),
    ("kpi_genre_performance", 5, 30),
    ("kpi_yearly_trends", 20, 100),
    ("kpi_top_movies", 100, 1_000_000),
)


def declared_checks(as_of: dt.date) -> list[Check]:
    """All 116 checks; NULLs pass the bounds, as every bound applies to known values only."""
    checks = [
        Check(t, f"not_null_{c}", "not_null", c) for t, columns in NOT_NULL.items() for c in columns
    ]
    checks += [Check(t, f"unique_{c}", "unique", c) for t, columns in UNIQUE.items() for c in columns]
    checks += [
        Check(t, f"relationships_{c}", "relationships", c, parent=p, parent_column=pc)
        for t, c, p, pc in RELATIONSHIPS
    ]
    checks += [Check(t, f"accepted_values_{c}", "accepted_values", c, values=v) for t, c, v in ACCEPTED]
    checks += [
        Check(t, f"between_{c}", "between", c, low=low, high=high)
        for t, bounds in BETWEEN.items()
        for c, low, high in bounds
    ]
    checks += [Check(t, "row_count", "row_count", low=low, high=high) for t, low, high in ROW_COUNTS]
    gap = F.col("profit_usd") - (F.col("revenue_usd") - F.col("budget_usd"))
    latest = F.add_months(F.lit(as_of), 24)
    checks += [
        Check("fact_movies", "revenue_not_negative", "rule", rule=F.col("revenue_usd") >= 0),
        Check("fact_movies", "profit_equals_revenue_minus_budget", "rule", rule=F.abs(gap) <= 100),
        Check("silver_movies", "no_future_releases", "rule", rule=F.col("release_date") <= latest),
    ]
    return checks
