"""Personal data by gradient-boosted candidates, by DataFrame operations only.

Loose patterns propose overlapping candidates. Each gets format features (digits, separators, length) and context
features (the characters and the word around it), all of few values, so that the candidates of a whole corpus sum up to
a table of feature cells with counts, of bounded size. Boosted trees are grown on that table. Their target is whether a
candidate says an address or number in other signs: brought to its plain form it passes the check of its kind. Each
strict span also takes part masked, in the signs in which people write it to escape the strict patterns. The trees become
a Spark column, a threshold per kind is calibrated on documents that the trees have not seen, and loose candidates above it
are redacted besides the strict ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm import spans
from tierwise.llm.common import stored, whole_text
from tierwise.llm.trees import boost

KINDS = ("email", "ip", "card", "phone")
# The base patterns; possessive, which changes no match but keeps the search linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Loose generators, one per kind: what might be an address, and runs of digits and separators.
LOOSE = (
    r"(?<![^\s<>()\[\],;:\"'])[^\s<>()\[\],;:\"'@]{1,64}+(?:@|\s?[(\[](?:at|AT)[)\]]\s?)[^\s<>()\[\],;:\"'@]{3,}+",
    r"(?<![0-9A-Za-z.])[0-9]{1,4}+(?:[.:][0-9]{1,4}+){3,7}+",
    r"(?<![0-9A-Za-z.])[0-9]{3,6}+(?:[\x20._-]{0,2}[0-9]{2,6}+){2,5}+",
    r"(?<![0-9A-Za-z.])(?:\+|00)?[(]?[0-9]{1,4}+[)]?(?:[\x20./-]{1,2}[(]?[0-9]{2,5}+[)]?){2,5}+",
)
AROUND = 24
PRECISION = 0.98
HALVES = 2


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    each = F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), lambda c, i: value(c, i))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def passes(kind: int, span: Column) -> Column:
    """The rule that a match of the base pattern must pass."""
    value = span["value"]
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(_digits(value))
    return n.between(16, 19) & luhn(_digits(value)) if kind == 2 else n.between(8, 15)


def plain(kind: int, value: Column) -> Column:
    """Whether a loose candidate, brought to the plain form of its kind, passes the check of the kind."""
    if kind == 0:
        return F.regexp_replace(value, r"\s?[(\[](?:at|AT)[)\]]\s?", "@").rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")
    if kind == 1:
        dotted = F.translate(value, ":", ".")
        return dotted.rlike(r"^[0-9]++(?:\.[0-9]++){3}$") & passes(1, F.struct(dotted.alias("value")))
    if kind == 2:
        return passes(2, F.struct(value.alias("value")))
    # A number, also one with an extension of up to six digits behind a space.
    number, short = (F.length(F.regexp_replace(_digits(v), "^00", "")) for v in (value, F.regexp_replace(value, r"\x20[0-9]{1,6}$", "")))
    return value.rlike(r"^(?:\+|00)") & (number.between(8, 15) | short.between(8, 15))


def masked(kind: int, value: Column) -> Column:
    """A strict span in signs that the strict pattern of its kind does not know, but the loose one does."""
    if kind == 0:
        return F.regexp_replace(value, "@", " (at) ")
    if kind == 1:
        return F.translate(value, ".", ":")
    if kind == 2:
        return F.regexp_replace(_digits(value), "([0-9]{4})(?=[0-9]{2})", "$1.")
    return F.regexp_replace(value, r"^\+", "00")


def _bins(value: Column, edges: tuple[int, ...]) -> Column:
    return reduce(lambda a, b: a + b, [(value >= e).cast("int") for e in edges])


def _features(kind: int, value: Column, text_before: Column, text_after: Column) -> list[Column]:
    last = F.substring(text_before, -1, 1)
    first = F.substring(text_after, 1, 1)
    glyph = lambda c: F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}\p{Nd}]"), 2).otherwise(3)
    words = r"(?i)(?:mail|e-?mail|contact|tel|phone|call|fax|mobile|card|visa|account|iban|ip|host|server|address|addr)\S*\s*$"
    return [
        _bins(F.length(_digits(value)), (4, 8, 10, 11, 13, 16, 20)),
        _bins(F.length(F.regexp_replace(value, r"[\p{L}\p{Nd}]", "")), (1, 2, 3, 4, 6)),
        _bins(F.length(value), (8, 12, 16, 20, 32)),
        F.when(value.startswith("+"), 1).when(value.startswith("00"), 4).when(value.rlike(r"[(\[](?:at|AT)[)\]]\s?[^@]+\.[A-Za-z]{2,}$"), 5).when(value.rlike(r"[.:][0-9]+[.:]"), 2).when(value.rlike(r"@[^@]+\.[A-Za-z]{2,}$"), 3).otherwise(0),
        glyph(last),
        glyph(first),
        text_before.rlike(words).cast("int"),
        text_before.rlike(r"(?:^|\n)\s*$").cast("int"),
    ]


@dataclass
class PiiModel:
    """Per kind: the trees, as (value, conditions) leaves, and the score from which a loose candidate is redacted."""

    base: list[float]
    leaves: list[list[tuple[float, tuple[tuple[int, bool, float], ...]]]]
    thresholds: list[float]

    def keeps(self, kind: int, features: Column) -> Column:
        total = F.lit(self.base[kind])
        for weight, path in self.leaves[kind]:
            holds = F.lit(True)
            for f, above, cut in path:
                holds = holds & ((features[f] > cut) if above else (features[f] <= cut))
            total = total + F.when(holds, weight).otherwise(0.0)
        return total >= self.thresholds[kind]


def candidates(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(tag, half, id, base, loose, masks): strict spans, loose candidates with features and whether their plain form
    passes, and the features of the masked strict spans. Context goes as far as the candidate before and after.
    """
    text = docs.select(F.col(id_column).alias("id"), whole_text(F.col(text_column)).alias("text"))
    # What every match of a pattern holds.
    text = text.withColumns({"digit": F.col("text").rlike("[0-9]"), "at": F.col("text").rlike(r"@|[(\[](?:at|AT)[)\]]"), "plus": F.contains("text", F.lit("+"))})
    possible = [F.col(c) for c in ("at", "digit", "digit", "plus", "at", "digit", "digit", "digit")]
    patterns = [*zip((EMAIL, IP, CARD, PHONE), "bbbb", strict=True), *zip(LOOSE, "llll", strict=True)]
    half = F.pmod(F.xxhash64("id", "text"), F.lit(HALVES)).alias("half")  # rows with equal id and text go together
    cut = text.select("id", half, *[c.alias(f"{n}_{side}{i % 4}") for i, (p, side) in enumerate(patterns) for n, c in zip("gm", spans.pieces(F.col("text"), p, possible[i], AROUND), strict=True)])

    def around(name: str) -> Column:
        gaps = F.col(f"g_{name}")
        with_context = lambda s, k: s.withField("before", gaps[k]["tail"]).withField("after", gaps[k + 1]["head"])
        return F.transform(spans.spans(gaps["n"], F.col(f"m_{name}")), with_context).alias(name)

    placed = cut.select("id", "half", *[around(f"{side}{i}") for side in "bl" for i in range(4)])
    checked = placed.select("id", "half", *[F.filter(f"b{i}", partial(passes, i)).alias(f"b{i}") for i in range(4)], *[f"l{i}" for i in range(4)])

    def mark(i: int, s: Column) -> Column:
        return F.struct(F.lit(i).alias("ord"), F.lit(KINDS[i]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    def loose(i: int, s: Column) -> Column:
        # rtrim of what the generator takes too much at the end of a sentence
        value = F.regexp_replace(s["value"], r"[^\p{L}\p{Nd})]+$", "")
        n = F.length(value)
        after = F.when(n < F.length(s["value"]), F.substr(s["value"], n + 1, F.lit(1))).otherwise(s["after"])
        features = F.array(*_features(i, value, s["before"], after))
        return F.struct(F.lit(i).alias("ord"), F.lit(KINDS[i]).alias("kind"), s["start"].alias("start"), (s["start"] + n).alias("end"), features.alias("x"), plain(i, value).alias("passes"))

    def mask(i: int, s: Column) -> Column:
        return F.struct(F.lit(i).alias("ord"), F.array(*_features(i, masked(i, s["value"]), s["before"], s["after"])).alias("x"))

    lists = [F.concat(*[F.transform(f"{side}{i}", partial(entry, i)) for i in range(4)]) for side, entry in (("b", mark), ("l", loose), ("b", mask))]
    named = [c.alias(n) for c, n in zip(lists, ("base", "loose", "masks"), strict=True)]
    return stored(checked.select(F.monotonically_increasing_id().alias("tag"), "half", "id", *named), "pii_candidates")


def fit(rows: DataFrame, precision: float = PRECISION) -> PiiModel:
    """Trees on the feature cells of one half of the documents, thresholds on those of the other half.

    The cells are counted over all candidates; their number is bounded by the product of the features' values.
    """
    seen = rows.select("half", F.explode("loose").alias("c")).select("half", "c.ord", "c.x", F.col("c.passes").cast("long").alias("s"))
    hidden = rows.select("half", F.explode("masks").alias("c")).select("half", "c.ord", "c.x", F.lit(1).cast("long").alias("s"))
    single = seen.unionAll(hidden)
    cells = single.groupBy("half", "ord", "x").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s")).collect()
    cells.sort(key=lambda r: (r.half, r.ord, r.x))
    base, leaves, thresholds = [], [], []
    for kind in range(len(KINDS)):
        seen = [(r.x, r.n, r.s) for r in cells if r.ord == kind and r.half == 0]
        fresh = [(r.x, r.n, r.s) for r in cells if r.ord == kind and r.half == 1]
        start, trees, score = boost(seen)
        ranked = sorted(((score(x), n, s) for x, n, s in fresh), reverse=True)
        threshold, n_all, s_all, i = float("inf"), 0, 0, 0
        while i < len(ranked):
            value = ranked[i][0]
            while i < len(ranked) and ranked[i][0] == value:
                n_all, s_all, i = n_all + ranked[i][1], s_all + ranked[i][2], i + 1
            if s_all >= precision * n_all:
                threshold = value - 1e-9
        base.append(start)
        leaves.append(trees)
        thresholds.append(threshold)
    return PiiModel(base, leaves, thresholds)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", precision: float = PRECISION) -> DataFrame:
    """One row per document: id, found (spans by kind, then start: ord, kind, start, end, strict).

    Strict spans always stay. A loose candidate is added when its score reaches the threshold of its kind and no strict
    span overlaps it; of overlapping loose ones the leftmost kind stays. Null texts count as empty; repeated rows
    give repeated rows; an empty table gives no rows. Other columns are ignored.
    """
    rows = candidates(docs, id_column, text_column)
    model = fit(rows, precision)

    def added(x: Column) -> Column:
        keeps = F.lit(False)
        for kind in range(len(KINDS)):
            keeps = keeps | ((x["ord"] == kind) & model.keeps(kind, x["x"]))
        return keeps

    def entry(x: Column, is_strict: bool) -> Column:
        return F.struct(x["ord"].alias("ord"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), F.lit(is_strict).alias("strict"))

    both = [F.transform("base", lambda x: entry(x, True)), F.transform(F.filter("loose", added), lambda x: entry(x, False))]
    scored = rows.select("tag", F.explode(F.concat(*both)).alias("x")).select("tag", "x.*")
    free = scored.withColumn("hit", spans.overlaps(F.col("strict"), "tag")).where("strict or not hit")
    second = F.lit(False)
    for kind in range(1, len(KINDS)):
        second = F.when(F.col("ord") == kind, spans.overlaps(~F.col("strict") & (F.col("ord") < kind), "tag")).otherwise(second)
    left = free.withColumn("second", second).where("strict or not second")
    lists = left.groupBy("tag").agg(F.array_sort(F.collect_list(F.struct("ord", "start", "end", "kind", "strict"))).alias("found"))
    none = F.array().cast(lists.schema["found"].dataType)
    return rows.select("tag", "id").join(lists, "tag", "left").select("id", F.coalesce("found", none).alias("found"))


def redact(text: Column, found: Column) -> Column:
    """The text with every span of ``found`` replaced by its kind in brackets; overlapping spans are replaced together."""
    by_start = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def add(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(inside, state["out"]).otherwise(F.concat(state["out"], F.array(piece))).alias("out"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(by_start, nothing, add, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))


def digest_columns(found: DataFrame) -> DataFrame:
    """The counts and digests of ``scan``'s spans."""
    strict_ones = F.filter("found", lambda x: x["strict"])

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["strict"] & (x["kind"] == kind))).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    more = F.size(F.filter("found", lambda x: ~x["strict"])).cast("long").alias("n_loose")
    return found.select("id", *counts, spans.digest(spans.joined(strict_ones)).alias("base_sha256"), spans.joined(F.col("found")).alias("spans"), more)
