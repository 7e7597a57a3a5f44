"""Quality scores from a sparse rule ensemble.

Small boosted trees are grown over text statistics of a bounded sample of labelled rows; every path from a root is a
rule, a conjunction of thresholds. A lasso logistic regression over the rules keeps few of them, and the kept ones
become one Spark column, so that scoring is a scan without Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm.common import SPACE_CLASS, free_name, whole_text

#: Labelled rows that a model is fitted on at most: those with the smallest hash of their id.
MAX_TRAIN_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
TREES, DEPTH, BINS, SHRINKAGE = 40, 3, 32, 0.3
PENALTIES = (0.03, 0.01, 0.003, 0.001)
STEPS = 400

Condition = tuple[int, bool, float]  # feature, above?, threshold


_COUNTED = {
    "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": "0123456789",
    "symbols": "#$%&*+/<=>@\\^_`~",
    "bars": "|",
    "shouts": "!?",
    "stops": ".",
    "commas": ",;:",
}


def marks(text: Column) -> Column:
    """The characters of a text that are counted one by one, a small part of most texts."""
    return F.regexp_replace(whole_text(text), r"[^A-Z0-9#$%&*+/<=>@\\^_`~|!?.,;:]+", "")


def statistics(text: Column, marked: Column | None = None) -> dict[str, Column]:
    """Statistics of a text, none of them null; all zero for an empty text. ``marked`` may hold its ``marks``."""
    marked = marks(text) if marked is None else marked
    text = whole_text(text)
    chars = F.length(text).cast("double")
    words = F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")
    n_words = F.size(words).cast("double")

    def share(characters: str) -> Column:
        found = F.length(marked) - F.length(F.translate(marked, characters, ""))
        return F.when(chars == 0, 0.0).otherwise(found / chars)

    return {
        "chars": chars,
        "words": n_words,
        "word_length": F.when(n_words == 0, 0.0).otherwise(F.length(F.translate(text, " \t\n\x0b\x0c\r", "")) / n_words),
        "different_words": F.when(n_words == 0, 0.0).otherwise(F.size(F.array_distinct(words)) / n_words),
        "line_length": chars / F.size(F.split(text, "\n")),
        **{name: share(characters) for name, characters in _COUNTED.items()},
    }


def held_out(id_column: Column) -> Column:
    """Rows never learnt from: the remainder of the id's checksum is 0. A null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class RuleModel:
    """score = logistic(base + the weights of the rules that hold)."""

    features: list[str]
    base: float
    rules: list[tuple[float, tuple[Condition, ...]]] = field(default_factory=list)

    def column(self, values: dict[str, Column]) -> Column:
        total = F.lit(float(self.base))
        for weight, rule in self.rules:
            holds = F.lit(True)
            for feature, above, threshold in rule:
                value = values[self.features[feature]]
                holds = holds & ((value > threshold) if above else (value <= threshold))
            total = total + F.when(holds, float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, target: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, path: tuple[Condition, ...], leaves: list) -> None:
    """One regression tree; ``leaves`` gets (path, value, rows) of every node but the root."""
    if path:
        leaves.append((path, target[rows].sum() / (weight[rows].sum() + 1.0), rows, True))
    if len(path) == DEPTH or len(rows) < 20:
        return
    best, g, h = None, target[rows], weight[rows]
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        place = np.searchsorted(cut, x[rows, f], side="left")
        gs, hs = np.cumsum(np.bincount(place, g, len(cut) + 1)), np.cumsum(np.bincount(place, h, len(cut) + 1))
        n = np.cumsum(np.bincount(place, minlength=len(cut) + 1))[:-1]
        gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1)
        gain[(n < 10) | (len(rows) - n < 10)] = -1
        i = int(np.argmax(gain))
        if gain[i] > 1e-9 + gs[-1] ** 2 / (hs[-1] + 1) and (best is None or gain[i] > best[0]):
            best = (gain[i], f, float(cut[i]))
    if best is None:
        return
    if path:
        leaves[-1] = (*leaves[-1][:3], False)
    _, f, threshold = best
    above = x[rows, f] > threshold
    _grow(x, target, weight, cuts, rows[~above], (*path, (f, False, threshold)), leaves)
    _grow(x, target, weight, cuts, rows[above], (*path, (f, True, threshold)), leaves)


def _tree_rules(x: np.ndarray, y: np.ndarray) -> list[tuple[Condition, ...]]:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    score = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    rules: dict[tuple[Condition, ...], None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        nodes: list = []
        _grow(x, y - p, p * (1 - p), cuts, np.arange(len(y)), (), nodes)
        for path, value, rows, leaf in nodes:
            rules[tuple(sorted(path))] = None
            if leaf:
                score[rows] += SHRINKAGE * value
    return list(rules)


def _holds(x: np.ndarray, rule: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for f, above, threshold in rule:
        out &= (x[:, f] > threshold) if above else (x[:, f] <= threshold)
    return out


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient steps over the different rows of z."""
    n = len(y)
    z, place = np.unique(z, axis=0, return_inverse=True)
    count, ones = np.bincount(place.ravel()).astype(float), np.bincount(place.ravel(), y)
    k = z.shape[1]
    step = 4.0 / (np.linalg.norm(z * np.sqrt(count / n)[:, None], 2) ** 2 + 1)
    b = c = np.log((y.sum() + 1) / (n - y.sum() + 1))
    w, v, t = np.zeros(k), np.zeros(k), 1.0
    for _ in range(STEPS):
        error = (count / (1 + np.exp(-(z @ v + c))) - ones) / n
        moved = v - step * (z.T @ error)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_b = c - step * error.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return float(b), w


def fit(features: list[str], x: np.ndarray, y: np.ndarray) -> RuleModel:
    """A model from a matrix of statistics and labels 0 or 1; a constant one when a class is missing."""
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if len(y) < 40 or y.min() == y.max():
        return RuleModel(features, prior)
    rules = _tree_rules(x, y)
    z = np.stack([_holds(x, r) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    if not rules:
        return RuleModel(features, prior)
    check = np.arange(len(y)) % FOLDS == 0
    losses = []
    for penalty in PENALTIES:
        b, w = _lasso(z[~check], y[~check], penalty)
        p = np.clip(1 / (1 + np.exp(-(z[check] @ w + b))), 1e-6, 1 - 1e-6)
        losses.append(-np.mean(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)))
    b, w = _lasso(z, y, PENALTIES[int(np.argmin(losses))])
    return RuleModel(features, b, [(float(w[i]), rules[i]) for i in np.flatnonzero(w)])


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> RuleModel:
    """Fit on at most ``max_rows`` labelled rows that are not held out.

    Several labels of one id count as their majority, 1 when even; null labels and ids are left out.
    """
    ids = F.col(id_column)
    voted = labels.where(ids.isNotNull() & F.col(label_column).isNotNull() & ~held_out(ids)).groupBy(id_column).agg((F.avg(label_column) >= 0.5).cast("int").alias("label"))
    sample = voted.orderBy(F.xxhash64(id_column), id_column).limit(max_rows).select(ids.alias("id"), "label")
    values = statistics(F.col("text"), F.col("marked"))
    picked = docs.select(ids.alias("id"), F.col(text_column).alias("text")).join(F.broadcast(sample), "id")
    picked = picked.withColumn("marked", marks(F.col("text")))
    rows = picked.select("id", "label", *[v.alias(k) for k, v in values.items()]).collect()
    rows.sort(key=tuple)
    x = np.array([r[2:] for r in rows], dtype=float).reshape(len(rows), len(values))
    return fit(list(values), x, np.array([r.label for r in rows], dtype=float))


def score(docs: DataFrame, model: RuleModel, name: str, text_column: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: the probability, 0 to 1, that the text is of quality. Null counts as empty."""
    parts = {k: free_name(docs, f"stat_{k}") for k in model.features}
    marked = free_name(docs, "stat_marked")
    values = statistics(F.col(text_column), F.col(marked))
    # Marks and statistics get projections of their own, so that each is computed once and not in every rule.
    with_marks = docs.withColumn(marked, marks(F.col(text_column)))
    with_parts = with_marks.select("*", *[values[k].alias(v) for k, v in parts.items()])
    scored = with_parts.withColumn(name, model.column({k: F.col(v) for k, v in parts.items()}))
    return scored.drop(marked, *parts.values())


def keep_good(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows with a score of ``threshold`` or more, with the columns of ``docs``."""
    name, kept = free_name(docs, "quality_score"), free_name(docs, "quality_kept")
    scored = score(docs, model, name, text_column)
    # A filter on the score itself would be pushed below the projections, and every rule would compute its statistics
    # anew; it is not pushed below a generator.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = scored.select(*columns, F.inline(F.array(F.struct(F.col(name).alias(kept)))))
    return once.where(F.col(kept) >= threshold).select(*columns)
