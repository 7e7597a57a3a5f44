"""What several operators share: stored intermediate tables, row keys, words."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.sources.shared_folder import scratch_path

#: The white space that separates words, as the inside of a character class.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = "\t\n\x0b\x0c\r "
#: Stands for a null doc_id where ids are compared: after every other id.
LAST_ID = 2**63 - 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: it is computed once and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that nothing reads any more: all that was derived from them is stored itself."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(column: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def row_key(id_column: str, text_column: str) -> Column:
    """A key of a row that any scan of the table gives alike. Rows with equal id and text share it, and share every
    decision that depends on id and text."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices_by_bytes(batch, column: str | int, limit: int):
    """Parts of an Arrow batch with about ``limit`` bytes of text each, at least one row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)
