"""Newest row per key of a stream, kept in a stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tierwise.operators.dedup import keep_latest
from tierwise.operators.merge import add_rows
from tierwise.sources.tables import BUCKETS, TableStore


def upsert_stream(
    stream: DataFrame,
    store: TableStore,
    layer: str | None,
    table: str,
    keys: Sequence[str],
    newest: str,
    checkpoint: str,
    ties: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Merge all files that arrived since the last call, then stop.

    No watermark is needed: a late row loses to a newer one of its key, whichever batch it comes in,
    and a batch that is replayed after a failure changes nothing. A batch rewrites the hash buckets
    that hold its keys, not the table.
    """

    def merge(batch: DataFrame, _: int) -> None:
        rows = keep_latest(batch, keys, newest, ties)
        target = TableStore(batch.sparkSession, store.root, store.environment, store.prefix)
        if not target.exists(layer, table):
            target.replace(rows, layer, table, keys, buckets)
        elif not batch.isEmpty():
            target.update(batch, lambda past: keep_latest(add_rows(past, rows), keys, newest, ties), layer, table)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
