"""Row counts per layer and the run log."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tierwise.operators.dedup import keep_latest
from tierwise.sources.tables import TableStore

RUN_LOG = (
    "invocation_id string, target_name string, run_start_at timestamp, run_end_at timestamp, "
    "run_status string, models_total bigint, models_completed bigint, models_errored bigint, "
    "run_command_args string, run_by string"
)
MODEL_LOG = (
    "invocation_id string, model_name string, model_schema string, model_database string, "
    "completed_at timestamp, target_name string"
)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, as one union."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def load_window(df: DataFrame, stamp: str) -> DataFrame:
    """Newest and oldest load time and the row count."""
    return df.agg(
        F.max(stamp).alias("latest_ingestion"),
        F.min(stamp).alias("earliest_ingestion"),
        F.count(F.lit(1)).alias("total_raw_rows"),
    )


def require_rows(df: DataFrame, name: str) -> None:
    """Raise when a table is empty after a load."""
    if df.isEmpty():
        raise ValueError(f"{name} is empty after the load")


class RunLog:
    """Events of a run, RUNNING and then SUCCESS or FAILED, and one row per model built.

    Both tables are only appended to, so runs side by side lose nothing; :func:`run_log` gives the state of each run.
    """

    def __init__(self, store: TableStore, layer: str | None = None, run_by: str = "spark"):
        self.store, self.layer, self.run_by = store, layer, run_by
        self.invocation_id = str(uuid.uuid4())
        self.statuses: list[str] = []
        self.built: list[tuple] = []
        self.started: tuple | None = None

    def _frame(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.store.spark.createDataFrame(rows, schema)

    def start(self, at: dt.datetime, models: int, arguments: str = "ALL") -> None:
        self.started = (at, models, arguments)
        row = (self.invocation_id, self.store.environment, at, None, "RUNNING", models, 0, 0, arguments, self.run_by)
        self.store.append(self._frame([row], RUN_LOG), self.layer, "dbt_run_log")

    def model(
        self, name: str, schema: str, at: dt.datetime, status: str = "success", listed: bool = True
    ) -> None:
        """Count a model's result; successful ones get a row at the end unless not ``listed``."""
        self.statuses.append(status)
        if listed and status in ("success", "pass"):
            self.built.append((self.invocation_id, name, schema, self.store.root, at, self.store.environment))

    def finish(self, at: dt.datetime) -> None:
        """Log the end of the run; any status but success, pass, error and fail counts as neither."""
        done = sum(s in ("success", "pass") for s in self.statuses)
        errors = sum(s in ("error", "fail") for s in self.statuses)
        begun, models, arguments = self.started
        status = "FAILED" if errors else "SUCCESS"
        row = (
            self.invocation_id, self.store.environment, begun, at, status,
            models, done, errors, arguments, self.run_by,
        )
        self.store.append(self._frame([row], RUN_LOG), self.layer, "dbt_run_log")
        if self.built:
            self.store.append(self._frame(self.built, MODEL_LOG), self.layer, "dbt_model_log")


def run_log(store: TableStore, layer: str | None = None) -> DataFrame:
    """One row per run: its last event."""
    return keep_latest(store.read(layer, "dbt_run_log"), ["invocation_id"], "run_end_at")


def models_of_latest_run(runs: DataFrame, models: DataFrame) -> DataFrame:
    """Model rows of the run that started last."""
    latest = runs.orderBy(F.col("run_start_at").desc_nulls_last(), "invocation_id").limit(1)
    return models.join(latest.select("invocation_id"), "invocation_id", "left_semi")
