"""Spans of pattern matches in a text, as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, Window, functions as F

#: Matches summed up at once; longer lists are cut into blocks of this many, so that the work stays in proportion.
BLOCK = 128


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` and its lambdas name it."""
    return F.transform(F.array(value), body)[0]


def pieces(text: Column, pattern: str, possible: Column | None = None, around: int | None = None) -> tuple[Column, Column]:
    """The lengths of the texts between the leftmost non-overlapping matches, and the matches.

    ``possible`` is a cheap condition without which there is no match: other texts are not searched. With ``around``
    the gaps are (n, tail, head): their length, last ``around`` characters and first character.
    """
    def gap(x: Column) -> Column:
        if around is None:
            return F.length(x)
        return F.struct(F.length(x).alias("n"), F.right(x, F.lit(around)).alias("tail"), F.substring(x, 1, 1).alias("head"))

    gaps = F.transform(F.split(text, pattern, -1), gap)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if possible is None:
        return gaps, matches
    return F.when(possible, gaps).otherwise(F.array(gap(F.lit("")))), F.when(possible, matches).otherwise(F.array().cast("array<string>"))


def _summed(parts: Column, start: Column) -> Column:
    """Starts and ends from an array of (gap, match) in which all gaps and matches follow one another."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        end = begin + F.length(part["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), part["match"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(parts, F.struct(start.alias("at"), empty.alias("spans")), add, lambda s: s["spans"])


def spans(gaps: Column, matches: Column) -> Column:
    """array of (start, end, value) in code points, end exclusive, from the gap lengths and matches of ``pieces``."""

    def blocks(parts: Column) -> Column:
        last = F.floor((F.size(parts) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(parts, b * BLOCK + 1, BLOCK))

    def starts(lengths: Column) -> Column:
        return F.transform(lengths, lambda _, i: F.aggregate(F.slice(lengths, 1, i), F.lit(0), lambda n, x: n + x))

    def long(cut: Column) -> Column:
        lengths = F.transform(cut, lambda b: F.aggregate(b, F.lit(0), lambda n, p: n + p["gap"] + F.length(p["match"])))
        return F.flatten(F.zip_with(cut, once(lengths, starts), _summed))

    def placed(parts: Column) -> Column:
        return F.when(F.size(parts) <= BLOCK, _summed(parts, F.lit(0))).otherwise(once(blocks(parts), long))

    parts = F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    return once(F.filter(parts, lambda p: p["match"].isNotNull()), placed)


def overlaps(others: Column, by: str) -> Column:
    """Whether a row (start, end) overlaps another row with its ``by`` for which ``others`` holds.

    Two sweeps over the sorted starts, from both sides, so a text full of spans costs no pairs.
    """
    left = Window.partitionBy(by).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    right = Window.partitionBy(by).orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    reaches = F.max(F.when(others, F.col("end"))).over(left) > F.col("start")
    begins = F.min(F.when(others, F.col("start"))).over(right) < F.col("end")
    return F.coalesce(reaches, F.lit(False)) | F.coalesce(begins, F.lit(False))


def joined(marked: Column) -> Column:
    """``kind:start:end`` of each entry in the given order, joined by commas."""
    return F.array_join(F.transform(marked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
