"""Event-time windows and distinct rows over several runs of a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwise.streaming.windows import EventWindow, closed, distinct_stream, late_rows, window_stream, windowed

SCHEMA = "id int, at timestamp, k string"
DAY = dt.datetime(2024, 3, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


class Arrivals:
    """A folder that fills up, and a stream over it that is run after each arrival."""

    def __init__(self, spark, tmp_path, start):
        self.spark, self.path, self.start = spark, str(tmp_path), start

    def run(self, data):
        if data:
            self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.path}/in")
        query = self.start(stream, f"{self.path}/out", f"{self.path}/log")
        query.awaitTermination()
        out = self.spark.read.schema(self.spark.read.parquet(f"{self.path}/out").schema).parquet(f"{self.path}/out")
        return out, query


@pytest.mark.parametrize(
    ("window", "first", "second"),
    [
        (EventWindow("at", "10 minutes"), [("a", 0, 10, 2)], [("a", 0, 10, 2), ("a", 10, 20, 1), ("b", 20, 30, 1)]),
        (EventWindow("at", "10 minutes", "5 minutes"), [("a", -5, 5, 2), ("a", 0, 10, 2), ("a", 5, 15, 1)], [("a", -5, 5, 2), ("a", 0, 10, 2), ("a", 5, 15, 1), ("a", 10, 20, 1), ("b", 15, 25, 1), ("b", 20, 30, 1)]),
        (EventWindow("at", "6 minutes", session=True), [("a", 1, 9, 2)], [("a", 1, 9, 2), ("a", 13, 19, 1), ("b", 21, 27, 1)]),
    ],
)
def test_windows_are_given_out_once_and_late_rows_are_told(spark, tmp_path, window, first, second):
    start = lambda s, out, log: window_stream(s, window, "5 minutes", ["k"], {"n": F.count(F.lit(1))}, out, log)
    feed = Arrivals(spark, tmp_path, start)

    def got(df):
        minutes = [((F.col(c).cast("long") - F.lit(DAY).cast("timestamp").cast("long")) / 60).cast("int").alias(c) for c in ("window_start", "window_end")]
        return sorted(map(tuple, df.select("k", *minutes, "n").collect()))

    out, query = feed.run([(1, at(1), "a"), (2, at(3), "a"), (3, at(13), "a"), (4, at(21), "b"), (5, None, "a")])
    assert late_rows(query) == 0
    assert got(out) == first
    # Row 6 is late for every window of its own; the others come in order.
    out, query = feed.run([(6, at(2), "a"), (7, at(60), "c")])
    assert late_rows(query) >= 1 and got(out) == second
    again, query = feed.run([])
    assert got(again) == second
    rows = spark.createDataFrame([(1, at(1), "a"), (2, at(3), "a"), (3, at(13), "a"), (4, at(21), "b"), (7, at(60), "c")], SCHEMA)
    table = windowed(rows, window, ["k"], {"n": F.count(F.lit(1))})
    assert got(closed(table, F.lit(at(60)).cast("timestamp"), "5 minutes")) == second


def test_distinct_rows_of_a_stream(spark, tmp_path):
    start = lambda s, out, log: distinct_stream(s, ["id"], "at", "10 minutes", out, log)
    feed = Arrivals(spark, tmp_path, start)

    def got(df):
        return sorted(r.id for r in df.collect())

    out, _ = feed.run([(1, at(0), "x"), (1, at(2), "copy"), (2, at(5), "x")])
    assert got(out) == [1, 2]
    out, _ = feed.run([(2, at(6), "copy in a later run"), (3, at(8), "x")])
    assert got(out) == [1, 2, 3]
    out, _ = feed.run([(9, at(100), "moves the watermark")])
    assert got(out) == [1, 2, 3, 9]
    out, query = feed.run([(1, at(101), "after its key was forgotten"), (3, at(20), "late")])
    assert got(out) == [1, 1, 2, 3, 9] and late_rows(query) == 1
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 2
