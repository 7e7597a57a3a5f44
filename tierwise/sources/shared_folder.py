"""The folder all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession, types as T

_SHREDDING = "spark.sql.variant.inferShreddingSchema"
_lock, _writers, _before = threading.Lock(), Counter(), {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the one the context was given.

    Without either a local session gets a temporary folder; a cluster must name one, because a path
    on one machine is not visible to the others.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tierwise-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write ``df``, its VARIANT documents in one piece each.

    Spark would infer a column for every path of the documents, which costs more to write and to put together again than
    the models save, as they read most paths. The session's setting is put back once no such write is under way.
    """
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    if not any(isinstance(f.dataType, T.VariantType) for f in df.schema.fields):
        writer.parquet(path)
        return
    conf, session = df.sparkSession.conf, df.sparkSession._jsparkSession.sessionUUID()
    with _lock:
        if not _writers[session]:
            _before[session] = conf.get(_SHREDDING, None)
            conf.set(_SHREDDING, "false")
        _writers[session] += 1
    try:
        writer.parquet(path)
    finally:
        with _lock:
            _writers[session] -= 1
            if not _writers[session]:
                before = _before.pop(session)
                conf.unset(_SHREDDING) if before is None else conf.set(_SHREDDING, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files.

    They survive lost executors, are read by column, and their size is known to the planner.
    """
    path = scratch_path(df.sparkSession, "cut")
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
