"""Rounded measures and aggregates.

Sums and means run on DECIMAL, so a result does not depend on how Spark split the rows, and a sum
over a very large table cannot overflow BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHOLE = "decimal(20,0)"
FRACTION = "decimal(18,6)"
#: Returns on a tiny cost have many digits before the point.
PERCENT = "decimal(38,2)"


def difference_if_known(left: Column, right: Column) -> Column:
    """``left - right``, NULL unless both are known."""
    return F.when(left.isNotNull() & right.isNotNull(), left - right)


def return_pct(revenue: Column, cost: Column, places: int = 2) -> Column:
    """``(revenue - cost) / cost * 100``, only for a positive cost and a known revenue."""
    exact_cost, exact_revenue = cost.cast("decimal(38,0)"), revenue.cast("decimal(38,0)")
    gain = (exact_revenue - exact_cost) / exact_cost
    return F.when(
        (cost > 0) & revenue.isNotNull(), F.round(gain * F.lit(100), places).cast(f"decimal(38,{places})")
    )


def decimal_sum(value: Column, dtype: str = WHOLE) -> Column:
    """Exact, order-independent sum."""
    return F.sum(value.cast(dtype))


def rounded_sum(value: Column, places: int, unit: int = 1, dtype: str = WHOLE) -> Column:
    """Sum in units of ``unit``, rounded half up."""
    return F.round(decimal_sum(value, dtype) / F.lit(unit).cast("decimal(10,0)"), places)


def rounded_mean(value: Column, places: int, unit: int = 1, dtype: str = WHOLE) -> Column:
    """Mean in units of ``unit``, rounded half up; NULL over no known value."""
    known = F.nullif(F.count(value), F.lit(0)) * F.lit(unit)
    return F.round(decimal_sum(value, dtype) / known, places)


def share_pct(part: Column, whole: Column, places: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero."""
    return F.round(F.lit(100) * part.cast(WHOLE) / F.nullif(whole, F.lit(0)).cast(WHOLE), places)


def distinct_when(condition: Column, identity: Column) -> Column:
    """Distinct ``identity`` values among the rows that meet ``condition``."""
    return F.count_distinct(F.when(condition, identity))


def weighted_rating(rating: Column, votes: Column, min_votes: int, overall_mean: Column) -> Column:
    """Rating pulled towards the overall mean when there are few votes."""
    n = votes.cast("double")
    return (n * rating + F.lit(float(min_votes)) * overall_mean) / (n + F.lit(float(min_votes)))
