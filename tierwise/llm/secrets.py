"""Secret scans with corpus-wide ownership, by DataFrame operations only.

Patterns propose candidates. The hash of every candidate's value is counted over the distinct repositories and owners
that have it: a value that many owners have is an example copied from documentation, one that few owners have and that
looks live is somebody's credential. Base candidates always stay and are told apart by this; other long random-looking
tokens become spans only if they are owned and look live.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm import spans
from tierwise.llm.common import stored, whole_text

# The base patterns, in the order of their kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"  # runs of AKIA[A-Z0-9]+ with 16 characters or more
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"  # runs of [0-9a-f]+ with 32 characters or more
#: Further candidates: long runs of token characters.
OWNED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}+"
KINDS = ("assign", "access", "hex", "owned")
LEAST_VALUE = 8
#: A value that so many owners or fewer have is owned; one that more have is a widely copied example.
MAX_OWNERS = 2
#: Different characters that a live-looking value has at least.
LIVE_CHARACTERS = 10


def looks_live(value: Column) -> Column:
    """Letters and digits mixed, many different characters, no run of one character."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= LIVE_CHARACTERS) & ~value.rlike(r"(.)\1{4}")


def _random_looking(value: Column) -> Column:
    """Of a token without a keyword: live, with digits among capitals and small letters."""
    return looks_live(value) & value.rlike("[A-Z]") & value.rlike("[a-z]") & (F.length(F.regexp_replace(value, "[^0-9]", "")) >= 3)


def owner_of(source: Column) -> Column:
    """The owner of a repository named owner/name; a name without a slash owns itself."""
    return F.regexp_extract(source, "^([^/]*)", 1)


def candidates(docs: DataFrame, id_column: str, source_column: str, text_column: str) -> DataFrame:
    """(tag, id, repo, owner, found): per row the candidates (ord, kind, start, end, hash, live), without the text."""
    text = docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("repo"), whole_text(F.col(text_column)).alias("text"))
    # What every match of a pattern holds; a run of hexadecimal digits needs nothing that is cheaper to find.
    possible = {"p0": F.col("text").rlike("[:=]"), "p1": F.contains("text", F.lit("AKIA")), "p3": F.col("text").rlike("[0-9]")}
    text = text.withColumns(possible)
    patterns = ((ASSIGN, F.col("p0")), (ACCESS, F.col("p1")), (HEX, None), (OWNED, F.col("p3")))
    cut = text.select("id", "repo", *[c.alias(f"{n}{i}") for i, p in enumerate(patterns) for n, c in zip("gm", spans.pieces(F.col("text"), *p), strict=True)])
    placed = cut.select("id", "repo", *[spans.spans(F.col(f"g{i}"), F.col(f"m{i}")).alias(f"s{i}") for i in range(len(KINDS))])

    def entry(i: int, s: Column) -> Column:
        value = F.regexp_extract(s["value"], ASSIGN, 2) if i == 0 else s["value"]
        return F.struct(F.lit(i).alias("ord"), F.lit(KINDS[i]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.sha2(value.cast("binary"), 256).alias("hash"), looks_live(value).alias("live"))

    long_enough = F.filter("s0", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= LEAST_VALUE)
    random = F.filter("s3", lambda s: _random_looking(s["value"]))
    lists = (long_enough, F.col("s1"), F.col("s2"), random)
    found = F.concat(*[F.transform(x, partial(entry, i)) for i, x in enumerate(lists)])
    return stored(placed.select(F.monotonically_increasing_id().alias("tag"), "id", "repo", owner_of(F.col("repo")).alias("owner"), found.alias("found")), "secret_candidates")


def ownership(rows: DataFrame) -> DataFrame:
    """(hash, repos, owners): the distinct repositories and owners of every value, counted in steps that each shrink."""
    single = rows.select("repo", "owner", F.explode("found.hash").alias("hash")).distinct()
    return single.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos")).groupBy("hash").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))


def scan(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text", max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per document: id, found (spans by start, then kind: kind, start, end, repos, owners, state).

    state is copied for a value of more than ``max_owners`` owners, live for an owned one that looks live, else owned.
    Spans of kind owned are given only when live and outside of base spans. Null texts count as empty, a null
    source as one repository and owner; repeated rows give repeated rows; an empty table gives no rows. Other columns are
    ignored.
    """
    rows = candidates(docs, id_column, source_column, text_column)
    counts = stored(ownership(rows), "secret_owners")
    single = rows.select("tag", F.explode("found").alias("x")).select("tag", "x.*")
    state = F.when(F.col("owners") > max_owners, "copied").when(F.col("live"), "live").otherwise("owned")
    known = single.join(counts, "hash").select("tag", "start", "ord", "end", "kind", "repos", "owners", state.alias("state"))
    free = (F.col("state") == "live") & ~spans.overlaps(F.col("ord") < 3, "tag")
    known = known.withColumn("stays", (F.col("ord") < 3) | free).where("stays")
    entry = F.struct("start", "ord", "end", "kind", "repos", "owners", "state")
    lists = known.groupBy("tag").agg(F.array_sort(F.collect_list(entry)).alias("found"))
    none = F.array().cast(lists.schema["found"].dataType)
    return rows.select("tag", "id").join(lists, "tag", "left").select("id", F.coalesce("found", none).alias("found"))


def digest_columns(found: DataFrame) -> DataFrame:
    """The counts and digests of ``scan``'s spans."""

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("found", lambda x: x[field] == value)).cast("long")

    base = F.filter("found", lambda x: x["ord"] < 3)
    return found.select(
        "id",
        *[count("kind", k).alias(f"n_{k}") for k in KINDS],
        spans.digest(spans.joined(base)).alias("base_sha256"),
        spans.joined(F.col("found")).alias("spans"),
        *[count("state", s).alias(f"n_{s}_values") for s in ("copied", "live")],
    )
