"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.functions.dates import date_key, day_of_week, quarter_label, release_season


def date_dimension(
    spark: SparkSession, start: dt.date, end: dt.date, unknown_member: bool = False
) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end``.

    ``unknown_member`` adds the row that unmatched facts point to (key -1, all else NULL).
    """
    days = (end - start).days
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    calendar = spark.range(days).select(day.alias("d")).select(
        date_key(F.col("d")).alias("date_sk"),
        F.col("d").alias("full_date"),
        F.year("d").alias("calendar_year"),
        F.quarter("d").alias("calendar_quarter"),
        F.month("d").alias("calendar_month"),
        F.day("d").alias("day_of_month"),
        day_of_week(F.col("d")).alias("day_of_week"),
        F.dayofyear("d").alias("day_of_year"),
        F.weekofyear("d").alias("week_of_year"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.date_format("d", "MMM").alias("month_name_short"),
        F.date_format("d", "EEEE").alias("day_name"),
        quarter_label(F.col("d")).alias("quarter_label"),
        F.date_format("d", "yyyy-MM").alias("year_month"),
        day_of_week(F.col("d")).isin(0, 6).alias("is_weekend"),
        (~day_of_week(F.col("d")).isin(0, 6)).alias("is_weekday"),
        release_season(F.month("d")).alias("release_season"),
        F.year("d").alias("fiscal_year"),
        F.quarter("d").alias("fiscal_quarter"),
    )
    if unknown_member:
        unknown = spark.range(1).select(F.lit(-1).alias("date_sk"))
        calendar = calendar.unionByName(unknown, allowMissingColumns=True)
    return calendar
