"""Event-time windows and distinct rows of streams, with watermarks.

The same specification runs on a table, where all rows are there, and on a stream, where a window is given out once, when
the watermark (the newest event time seen, less the delay) has reached its end. A row is late when the watermark has
passed the end of its window (of its own session, for sessions): it is not counted, and :func:`late_rows` tells
how many such rows there were. State is kept for open windows only. Results go to Parquet files with a commit log of
the stream, so a batch that is repeated after a failure adds nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class EventWindow:
    """Windows over ``moment``: of ``width``, every ``slide`` if given, or sessions that end ``width`` after their last row."""

    moment: str
    width: str
    slide: str | None = None
    session: bool = False

    def column(self) -> Column:
        if self.session:
            return F.session_window(self.moment, self.width)
        return F.window(self.moment, self.width, self.slide)


def windowed(events: DataFrame, window: EventWindow, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Aggregates per key and window, with window_start and window_end; half-open intervals. Rows without a moment count nowhere."""
    groups = events.where(F.col(window.moment).isNotNull()).groupBy(*keys, window.column().alias("_window"))
    found = groups.agg(*[value.alias(name) for name, value in values.items()])
    return found.select(*keys, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *values)


def closed(windows: DataFrame, newest: Column, delay: str) -> DataFrame:
    """The windows that a watermark of ``delay`` behind the newest moment has passed: what a stream over the same rows gives out."""
    return windows.where(F.col("window_end") <= newest - F.expr(f"INTERVAL {delay}"))


def _watermarked(events: DataFrame, moment: str, delay: str) -> DataFrame:
    """The stream with a watermark, which needs an instant: a moment without a zone is read in the session's zone."""
    return events.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, delay)


def _to_files(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_stream(
    events: DataFrame, window: EventWindow, delay: str, keys: Sequence[str], values: Mapping[str, Column], path: str, checkpoint: str
) -> StreamingQuery:
    """Write the closed windows of all files that arrived since the last call to ``path``, then stop."""
    return _to_files(windowed(_watermarked(events, window.moment, delay), window, keys, values), path, checkpoint)


def distinct_stream(events: DataFrame, keys: Sequence[str], moment: str, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Write the first row of each key that arrives; further ones with a moment up to ``delay`` after it are dropped.

    A key is forgotten ``delay`` after its row's moment, so the state is bounded by the keys of that time. A copy that comes when
    its key is forgotten is a new row; one older than the watermark is late and dropped.
    """
    return _to_files(_watermarked(events, moment, delay).dropDuplicatesWithinWatermark(list(keys)), path, checkpoint)


def late_rows(query: StreamingQuery) -> int:
    """Rows of a finished run that came too late for their window or key."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
