"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cores: int | str = "*", memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark.

    On a cluster the session comes from the submitter. It should set ``spark.checkpoint.dir`` to a
    shared folder, keep adaptive execution on, and leave ``spark.sql.shuffle.partitions`` high
    (several times the cores): adaptive execution merges small partitions and splits skewed ones.
    """
    partitions = str(os.cpu_count() if cores == "*" else cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
