"""Marts: genre, year and movie KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.functions.measures import (
    FRACTION, PERCENT, WHOLE, decimal_sum, rounded_mean, rounded_sum, share_pct, weighted_rating,
)
from tierwise.operators.joins import lookup
from tierwise.operators.ranking import (
    Key, Rank, change_from_previous, global_ranks, group_medians, window_ranks,
)
from tierwise.plans.reference_data import (
    FIRST_TREND_YEAR, MIN_RANKED_VOTES, RECENT_YEARS, UNKNOWN,
)

MILLION = 1_000_000
ROI = PERCENT


def _best(name: str, column: str) -> Rank:
    return Rank(name, "rank", (Key(column, descending=True, nulls_last=True),))


def financially_complete(fact: DataFrame) -> Column:
    """Movies with a known revenue and a known, positive budget."""
    return F.col("budget_usd").isNotNull() & F.col("revenue_usd").isNotNull() & (F.col("budget_usd") > 0)


def kpi_genre_performance(
    fact: DataFrame, genres: DataFrame, as_of_year: int, fanout: bool = False
) -> DataFrame:
    """One row per genre, movies or not.

    The fact is unique by movie and its financially complete rows are a subset of it, so one
    pre-aggregated pass with conditional aggregates gives every measure, each movie counted once.

    ``fanout`` gives the totals of the literal double join instead, in which each of N movies meets
    each of M complete ones. The pairs are never formed: totals of one side are multiplied by the
    rows of the other, and the standard deviation is that of each value repeated M times. Means,
    medians, maxima and distinct counts are the same either way.
    """
    complete = financially_complete(fact)
    only = lambda c: F.when(complete, F.col(c))
    stats = fact.groupBy("genre_sk").agg(
        F.count("movie_id").alias("total_movies"),
        F.count_if(F.col("release_year") >= as_of_year - RECENT_YEARS).alias("movies_last_5_years"),
        F.count_if(complete).alias("movies_with_financial_data"),
        decimal_sum(only("revenue_usd")).alias("_revenue"),
        rounded_mean(only("revenue_usd"), 2, MILLION).alias("avg_revenue_millions"),
        F.round(F.max(only("revenue_usd")).cast(WHOLE) / F.lit(MILLION), 2).alias("max_revenue_millions"),
        rounded_mean(only("budget_usd"), 2, MILLION).alias("avg_budget_millions"),
        rounded_mean(only("profit_usd"), 2, MILLION).alias("avg_profit_millions"),
        decimal_sum(only("profit_usd")).alias("_profit"),
        rounded_mean(only("roi_pct"), 2, dtype=PERCENT).alias("avg_roi_pct"),
        share_pct(F.count_if(complete & (F.col("profit_usd") > 0)), F.count_if(complete)).alias(
            "pct_movies_profitable"
        ),
        rounded_mean(F.col("vote_average"), 2, dtype=FRACTION).alias("avg_rating"),
        F.var_samp("vote_average").alias("_rating_variance"),
        F.count("vote_average").alias("_rated"),
        F.round(F.max("vote_average"), 2).alias("highest_rating"),
        rounded_mean(F.col("vote_count"), 0).alias("avg_vote_count"),
        rounded_mean(F.col("popularity_score"), 2, dtype=FRACTION).alias("avg_popularity"),
        decimal_sum(F.col("popularity_score"), FRACTION).alias("_popularity"),
        rounded_mean(F.col("runtime_minutes"), 0).alias("avg_runtime_minutes"),
        F.max("_gold_loaded_at").alias("data_as_of"),
    )
    per_complete, per_movie = F.lit(1), F.lit(1)
    variance = F.col("_rating_variance")
    if fanout:
        per_complete = F.col("total_movies")
        per_movie = F.greatest(F.col("movies_with_financial_data"), F.lit(1))
        squares = variance * (F.col("_rated") - 1)
        repeated = F.col("_rated") * per_movie
        single = F.when((F.col("_rated") == 1) & (per_movie > 1), F.lit(0.0))
        variance = F.coalesce(single, per_movie * squares / F.nullif(repeated - 1, F.lit(0)))
    money = lambda c, times: F.round(F.col(c) * times / F.lit(MILLION), 2)
    stats = stats.withColumns(
        {
            "total_revenue_millions": money("_revenue", per_complete),
            "total_profit_millions": money("_profit", per_complete),
            "rating_stddev": F.round(F.sqrt(variance), 2),
            "total_popularity": F.round(F.col("_popularity") * per_movie, 2),
        }
    )
    typed = fact.filter(complete).select(
        "genre_sk", "movie_id", F.col("revenue_usd").cast(ROI), F.col("roi_pct").cast(ROI)
    )
    medians = group_medians(typed, ["genre_sk"], ["revenue_usd", "roi_pct"], ["movie_id"]).select(
        "genre_sk",
        F.round(F.col("revenue_usd") / F.lit(MILLION), 2).alias("median_revenue_millions"),
        F.round("roi_pct", 2).alias("median_roi_pct"),
    )
    counts = ["total_movies", "movies_last_5_years", "movies_with_financial_data"]
    named = genres.select("genre_sk", "genre_id", "genre_name", "genre_group", "is_blockbuster_genre")
    table = named.join(stats, "genre_sk", "left").join(medians, "genre_sk", "left").fillna(0, counts)
    columns = [
        *named.columns, *counts, "total_revenue_millions", "avg_revenue_millions",
        "median_revenue_millions", "max_revenue_millions", "avg_budget_millions",
        "avg_profit_millions", "total_profit_millions", "avg_roi_pct", "median_roi_pct",
        "pct_movies_profitable", "avg_rating", "rating_stddev", "highest_rating", "avg_vote_count",
        "avg_popularity", "total_popularity", "avg_runtime_minutes", "data_as_of",
    ]
    # One row per genre of the reference list: a plain window is the cheapest way to rank them.
    return window_ranks(
        table.select(*columns),
        ["genre_id"],
        [
            _best("roi_rank", "avg_roi_pct"),
            _best("revenue_rank", "total_revenue_millions"),
            _best("rating_rank", "avg_rating"),
            _best("volume_rank", "total_movies"),
        ],
    )


def kpi_yearly_trends(fact: DataFrame, loaded_at: Column) -> DataFrame:
    """One row per release year with changes against the year listed before it.

    The fact is unique by movie, so its distinct counts are plain conditional counts.
    """
    month, language, tier = F.col("release_month"), F.col("original_language"), F.col("budget_tier")
    with_budget = F.count_if(F.col("budget_usd").isNotNull())
    yearly = (
        fact.filter(F.col("release_year") >= FIRST_TREND_YEAR)
        .groupBy("release_year")
        .agg(
            F.count("movie_id").alias("total_movies_released"),
            F.count_if(language == "en").alias("english_movies"),
            F.count_if(language != "en").alias("non_english_movies"),
            F.count_if(month.isin(6, 7, 8)).alias("summer_releases"),
            F.count_if(month.isin(11, 12)).alias("holiday_releases"),
            with_budget.alias("movies_with_budget"),
            rounded_sum(F.col("revenue_usd"), 1, MILLION).alias("total_revenue_millions"),
            rounded_mean(F.col("revenue_usd"), 1, MILLION).alias("avg_revenue_millions"),
            rounded_mean(F.col("budget_usd"), 1, MILLION).alias("avg_budget_millions"),
            rounded_mean(F.col("roi_pct"), 1, dtype=PERCENT).alias("avg_roi_pct"),
            share_pct(F.count_if(F.col("profitability_flag") == "PROFITABLE"), with_budget).alias(
                "pct_profitable"
            ),
            rounded_mean(F.col("vote_average"), 2, dtype=FRACTION).alias("avg_rating"),
            rounded_mean(F.col("vote_count"), 0).alias("avg_vote_count"),
            rounded_mean(F.col("popularity_score"), 2, dtype=FRACTION).alias("avg_popularity"),
            rounded_mean(F.col("runtime_minutes"), 0).alias("avg_runtime_minutes"),
            F.count_if(tier == "BLOCKBUSTER").alias("blockbuster_count"),
            F.count_if(tier == "HIGH").alias("high_budget_count"),
            F.count_if(tier == "MID").alias("mid_budget_count"),
            F.count_if(tier == "LOW").alias("low_budget_count"),
            F.count_if(tier == "MICRO").alias("micro_budget_count"),
        )
    )
    base = yearly.columns
    changed = {
        "total_movies_released": "yoy_movie_count_change",
        "avg_budget_millions": "yoy_budget_change_millions",
        "avg_revenue_millions": "yoy_revenue_change_millions",
        "avg_rating": "yoy_rating_change",
    }
    # At most one row per calendar year from here on, so unpartitioned windows are bounded.
    trends = change_from_previous(yearly, "release_year", list(changed)).withColumns(
        {name: F.col(c) - F.col(f"previous_{c}") for c, name in changed.items()}
    )
    trends = trends.withColumn(
        "yoy_movie_count_pct",
        share_pct(F.col("yoy_movie_count_change"), F.col("previous_total_movies_released")),
    )
    ranked = window_ranks(
        trends,
        ["release_year"],
        [
            Rank("revenue_rank", "rank", (Key("total_revenue_millions", descending=True),)),
            Rank("volume_rank", "rank", (Key("total_movies_released", descending=True),)),
            _best("roi_rank", "avg_roi_pct"),
        ],
    )
    return ranked.select(
        *base, "yoy_movie_count_change", "yoy_movie_count_pct", "yoy_budget_change_millions",
        "yoy_revenue_change_millions", "yoy_rating_change", "revenue_rank", "volume_rank",
        "roi_rank", loaded_at.alias("_marts_loaded_at"),
    )


_REVENUE = (Key("revenue_usd", descending=True, nulls_last=True),)
TOP_MOVIE_RANKS = (
    Rank("revenue_rank_all_time", "dense_rank", _REVENUE),
    Rank("revenue_rank_in_year", "dense_rank", _REVENUE, partition=("release_year",)),
    Rank("roi_rank_all_time", "dense_rank", (Key("roi_pct", descending=True, nulls_last=True),)),
    Rank(
        "rating_rank_all_time", "dense_rank",
        (Key("vote_average", descending=True), Key("vote_count", descending=True)),
    ),
    Rank("popularity_rank_all_time", "dense_rank", (Key("popularity_score", descending=True),)),
    Rank("revenue_percentile", "percent_rank", (Key("revenue_usd"),), places=4),
    Rank("rating_percentile", "percent_rank", (Key("vote_average"),), places=4),
    Rank("popularity_percentile", "percent_rank", (Key("popularity_score"),), places=4),
    Rank("rating_decile", "ntile", (Key("vote_average"),)),
    Rank("revenue_decile", "ntile", (Key("revenue_usd"),)),
)


def kpi_top_movies(
    fact: DataFrame,
    genres: DataFrame,
    companies: DataFrame,
    loaded_at: Column,
    min_votes: int = MIN_RANKED_VOTES,
    weighted: bool = False,
) -> DataFrame:
    """Ranks, percentiles and deciles of all movies with enough votes.

    ``weighted`` adds the vote-weighted rating. Deciles settle ties by the lowest ``movie_id``.
    """
    voted = fact.filter(F.col("vote_count") >= min_votes)
    ranks = global_ranks(voted, ["movie_id"], TOP_MOVIE_RANKS)
    top = lookup(
        voted, genres, {"genre_sk": "genre_sk"}, {"primary_genre": "genre_name"},
        {"primary_genre": UNKNOWN},
    )
    top = lookup(
        top, companies, {"company_sk": "company_sk"},
        {"primary_company": "company_name", "studio_tier": "studio_tier"},
        {"primary_company": UNKNOWN, "studio_tier": UNKNOWN}, spread_by=["movie_id"],
    )
    columns = [
        "movie_id", "movie_sk", "title", "imdb_id", "release_year", "original_language",
        "primary_genre", "primary_company", "studio_tier", "budget_usd", "revenue_usd",
        "profit_usd", "roi_pct", "budget_tier", "profitability_flag", "vote_average", "vote_count",
        "popularity_score", "runtime_minutes",
    ]
    extra = []
    if weighted:
        mean = voted.agg(F.avg(F.col("vote_average").cast(FRACTION)).cast("double"))
        extra.append(
            weighted_rating(F.col("vote_average"), F.col("vote_count"), min_votes, mean.scalar()).alias("weighted_rating")
        )
    return top.join(ranks, "movie_id").select(
        *columns, *[r.name for r in TOP_MOVIE_RANKS], *extra, "_gold_loaded_at",
        loaded_at.alias("_marts_loaded_at"),
    )
