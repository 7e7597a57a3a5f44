"""Registration of queries and helpers that both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierwise.sources.shared_folder import scratch_path
from tierwise.sources.tables import TableStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_store(spark: SparkSession) -> TableStore:
    """An empty table store with databases of its own below the shared folder."""
    root = scratch_path(spark, "store")
    return TableStore(spark, root, prefix=f"scratch_{root[-12:]}_")


def plain(df: DataFrame) -> DataFrame:
    """Types that both engines print alike: BIGINT, DOUBLE, VARCHAR, DATE and BOOLEAN."""

    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, with its SQL counterpart."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(spark, sf_dir))

        run.__doc__ = function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def season_sql(date: str) -> str:
    """SQL for the season of a date. The release windows by calendar month."""
    return (
        f"CASE month({date}) WHEN 1 THEN 'WINTER' WHEN 2 THEN 'WINTER' WHEN 3 THEN 'WINTER' WHEN 4 THEN 'SPRING' "
        "WHEN 5 THEN 'SPRING' WHEN 6 THEN 'SUMMER' WHEN 7 THEN 'SUMMER' WHEN 8 THEN 'SUMMER' WHEN 9 THEN 'FALL' "
        "WHEN 10 THEN 'FALL' WHEN 11 THEN 'HOLIDAY' WHEN 12 THEN 'HOLIDAY' END"
    )


def half_up(number: str, divisor: str, places: int) -> str:
    """SQL for ``number / divisor`` of whole numbers, rounded half away from zero, as DOUBLE."""
    n, d, scale = f"CAST({number} AS HUGEINT)", f"CAST({divisor} AS HUGEINT)", 10**places
    rounded = f"sign({n}) * ((abs({n}) * {2 * scale} + {d}) // (2 * {d}))"
    return f"(CASE WHEN ({divisor}) = 0 THEN NULL ELSE CAST({rounded} AS DOUBLE) / {scale}.0 END)"


def sum6(column: str) -> str:
    """SQL for the sum of a DOUBLE column in millionths, as a whole number."""
    return f"sum(CAST(CAST({column} AS DECIMAL(18,6)) * 1000000 AS HUGEINT))"


def mean6(column: str, places: int) -> str:
    return half_up(sum6(column), f"count({column}) * 1000000", places)


def mean(column: str, places: int, unit: int = 1) -> str:
    return half_up(f"sum(CAST({column} AS HUGEINT))", f"count({column}) * {unit}", places)
