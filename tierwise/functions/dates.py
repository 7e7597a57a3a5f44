"""Date parsing and calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Release windows by calendar month.
SEASON_MONTHS = {
    "SUMMER": (6, 7, 8),
    "HOLIDAY": (11, 12),
    "WINTER": (1, 2, 3),
    "SPRING": (4, 5),
    "FALL": (9, 10),
}

# Fixed value: the date some sources send for "unknown".
UNKNOWN_DATE = "0001-01-01"


def moment(at: dt.datetime) -> Column:
    """A fixed clock reading as TIMESTAMP_NTZ, whatever the time zone of the driver's Python."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def safe_date(value: Column, fmt: str | None = None) -> Column:
    """Parse to DATE, NULL when the text is not a valid date."""
    text = value.cast("string")
    return F.try_to_date(text, fmt) if fmt else F.try_to_date(text)


def clean_date(value: Column, fmt: str | None = None) -> Column:
    """:func:`safe_date`, with the unknown-date sentinel turned into NULL."""
    return F.nullif(safe_date(value, fmt), F.lit(UNKNOWN_DATE).cast("date"))


def day_of_week(date: Column) -> Column:
    """Day of week counted from Sunday = 0."""
    return F.dayofweek(date) - F.lit(1)


def release_season(month: Column) -> Column:
    """Season label of a month number, NULL for NULL."""
    label = F.lit(None).cast("string")
    for season, months in SEASON_MONTHS.items():
        label = F.when(month.isin(*months), F.lit(season)).otherwise(label)
    return label


def fiscal_year(date: Column, start_month: int = 10) -> Column:
    """Fiscal year named after the calendar year it ends in."""
    if start_month == 1:
        return F.year(date)
    return F.year(date) + (F.month(date) >= start_month).cast("int")


def date_key(date: Column) -> Column:
    """Integer YYYYMMDD."""
    return F.date_format(date, "yyyyMMdd").cast("int")


def quarter_label(date: Column) -> Column:
    """``Q1`` to ``Q4``."""
    return F.concat(F.lit("Q"), F.quarter(date))


def date_parts(column: str, prefix: str | None = None) -> list[Column]:
    """The block of derived date columns, named ``<prefix>_year`` and so on."""
    date, name = F.col(column), prefix or column
    return [
        F.year(date).alias(f"{name}_year"),
        F.month(date).alias(f"{name}_month"),
        F.quarter(date).alias(f"{name}_quarter"),
        F.day(date).alias(f"{name}_day"),
        day_of_week(date).alias(f"{name}_dow"),
        F.date_format(date, "EEE").alias(f"{name}_day_name"),
        F.date_format(date, "yyyy-MM").alias(f"{name}_month_label"),
    ]
