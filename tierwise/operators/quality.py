"""Data checks. Each returns the violating rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Repeated keys with their row counts; NULL keys are ignored."""
    known = df.na.drop(subset=list(columns))
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys that the parent does not hold, with their row counts; NULL keys are ignored.

    The child is aggregated to its distinct keys first, so a key that many rows share (an unknown
    member, say) crosses the network once per map task and never fills one.
    """
    keys = df.na.drop(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_column).alias("_parent"))
    return keys.join(known, F.col(column) == F.col("_parent"), "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def between(
    df: DataFrame, column: str, low: object, high: object, where: Column | None = None
) -> DataFrame:
    """Rows outside ``low`` to ``high`` inclusive, among those that meet ``where``."""
    outside = ~F.col(column).between(low, high)
    return df.filter(outside if where is None else where & outside)


def row_count_between(df: DataFrame, low: int, high: int) -> DataFrame:
    """The row count, when it is out of bounds."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(~F.col("n_rows").between(low, high))


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which ``rule`` is false; unknown passes."""
    return df.filter(~rule)


def not_negative(df: DataFrame, column: str) -> DataFrame:
    return violations(df, F.col(column) >= 0)


def difference_matches(
    df: DataFrame, result: str, left: str, right: str, tolerance: int = 100
) -> DataFrame:
    """Rows whose ``result`` is further than ``tolerance`` from ``left - right``."""
    expected = F.col(left) - F.col(right)
    gap = F.abs(F.col(result) - expected)
    return violations(df, gap <= tolerance).withColumns(
        {"expected": expected, "discrepancy": gap}
    )


def not_far_future(df: DataFrame, column: str, as_of: Column, years: int = 2) -> DataFrame:
    """Rows dated more than ``years`` after ``as_of``, with the days ahead."""
    late = violations(df, F.col(column) <= F.add_months(as_of, 12 * years))
    return late.withColumn("days_in_future", F.date_diff(F.col(column), as_of))


def freshness(
    df: DataFrame, stamp: str, as_of: Column, warn_hours: int = 25, error_hours: int = 49
) -> DataFrame:
    """One row: newest load time, its age in hours, and pass, warn or error."""
    newest = df.agg(F.max(F.col(stamp).cast("timestamp")).alias("newest"))
    seconds = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp("newest")
    aged = newest.withColumn("age_hours", seconds / F.lit(3600))
    status = (
        F.when((F.col("age_hours") > error_hours) | F.col("newest").isNull(), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return aged.withColumn("status", status)


@dataclass(frozen=True)
class Check:
    """One declared check on one table of a suite.

    ``rule`` (row-level kinds) is the condition a row must not fail; ``rows`` is the function that
    gives the violating rows from the suite's tables.
    """

    table: str
    name: str
    kind: str
    column: str | None = None
    values: tuple = ()
    low: object = None
    high: object = None
    parent: str | None = None
    parent_column: str | None = None
    rule: Column | None = field(default=None, compare=False)
    severity: str = "fail"

    def failed_row(self) -> Column | None:
        """Condition that marks a violating row, for checks that look at one row at a time."""
        column = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(*self.values)
        if self.kind == "between":
            return ~column.between(self.low, self.high)
        if self.kind == "rule":
            return ~self.rule
        return None

    def missing(self, tables: Mapping[str, DataFrame]) -> bool:
        """Whether a table or column of the check is absent."""
        needed = [(self.table, self.column), (self.parent, self.parent_column)]
        return any(
            table not in tables or (column is not None and column not in tables[table].columns)
            for table, column in needed
            if table is not None
        )

    def failing_rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df, condition = tables[self.table], self.failed_row()
        if condition is not None:
            return df.filter(condition)
        if self.kind == "unique":
            return unique(df, self.column)
        if self.kind == "relationships":
            return relationships(df, self.column, tables[self.parent], self.parent_column)
        if self.kind == "row_count":
            return row_count_between(df, self.low, self.high)
        raise ValueError(f"unknown check kind {self.kind!r}")


SUMMARY = "table string, check string, failures bigint, status string"


def _count(check: Check) -> Column:
    """Failures of a check that one pass over its table can count."""
    if check.kind == "row_count":
        return (~F.count(F.lit(1)).between(check.low, check.high)).cast("bigint")
    return F.count_if(check.failed_row())


def _failures(tables: Mapping[str, DataFrame], table: str, checks: Sequence[Check]) -> list[int | None]:
    """Failure counts in one pass over a table; when it breaks off, check by check, None for those that break off."""
    try:
        return list(tables[table].agg(*[_count(c).alias(f"c{i}") for i, c in enumerate(checks)]).first())
    except Exception:  # noqa: BLE001  whatever ends a job is the check's result
        if len(checks) == 1:
            return [None]
        return [_failures(tables, table, [c])[0] for c in checks]


def _key_failures(tables: Mapping[str, DataFrame], check: Check) -> list[int | None]:
    """Failures of a check that groups its table by key, None when it breaks off."""
    try:
        return [check.failing_rows(tables).count()]
    except Exception:  # noqa: BLE001
        return [None]


def run_checks(
    spark: SparkSession, tables: Mapping[str, DataFrame], checks: Sequence[Check], threads: int = 4
) -> DataFrame:
    """Summary of a suite, one row per check: failures and pass, warn, fail or error.

    A check never stops the others: one that cannot be analysed (an absent table or column) or that fails
    while it runs (a bad cast) is reported as error, with no count. The row-level checks of a table share one pass;
    passes and checks of keys do not read each other and run side by side, ``threads`` at a time.
    """
    found: dict[int, int | None] = {}
    scans: dict[str, list[int]] = {}
    keyed: list[int] = []
    for i, check in enumerate(checks):
        if check.missing(tables):
            found[i] = None
        elif check.kind in ("unique", "relationships"):
            keyed.append(i)
        else:
            scans.setdefault(check.table, []).append(i)
    with ThreadPoolExecutor(threads) as pool:
        running = [([i], pool.submit(_key_failures, tables, checks[i])) for i in keyed]
        running += [(ns, pool.submit(_failures, tables, table, [checks[i] for i in ns])) for table, ns in scans.items()]
    for numbers, result in running:
        found |= dict(zip(numbers, result.result(), strict=True))
    status = lambda n, c: "error" if n is None else "pass" if n == 0 else c.severity
    rows = [(c.table, c.name, found[i], status(found[i], c)) for i, c in enumerate(checks)]
    return spark.createDataFrame(rows, SUMMARY)


def stored_failures(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The rows of one table that fail any of its ``checks``, in one pass, with the names of those they fail.

    Checks of more than one row (unique keys, missing parents, row counts) add their own rows.
    """
    single = [c for c in checks if c.failed_row() is not None]
    parts = [
        c.failing_rows(tables).withColumn("failed_checks", F.array(F.lit(c.name))) for c in checks if c.failed_row() is None
    ]
    if single:
        names = F.array_compact(F.array(*[F.when(c.failed_row(), c.name) for c in single]))
        parts.insert(0, tables[single[0].table].withColumn("failed_checks", names).filter(F.size("failed_checks") > 0))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
