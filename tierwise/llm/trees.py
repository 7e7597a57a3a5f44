"""Small boosted trees over a table of feature cells with counts."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

Path = tuple[tuple[int, bool, float], ...]  # (feature, above?, cut)
TREES, DEPTH, SHRINKAGE, LEAST = 20, 2, 0.3, 5


def _holds(x: Sequence[float], path: Path) -> bool:
    return all((x[f] > cut) == above for f, above, cut in path)


def _split(cells: list, depth: int, path: Path, out: list) -> None:
    """cells: (x, rows, gradient, curvature). ``out`` gets the leaves (value, path)."""
    g, h = sum(c[2] for c in cells), sum(c[3] for c in cells)
    best = None
    if depth:
        for f in range(len(cells[0][0])):
            for cut in sorted({c[0][f] for c in cells})[:-1]:
                low = [c for c in cells if c[0][f] <= cut]
                n, gl, hl = (sum(c[i] for c in low) for i in (1, 2, 3))
                if n < LEAST or sum(c[1] for c in cells) - n < LEAST:
                    continue
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1)
                if gain > g * g / (h + 1) + 1e-9 and (best is None or gain > best[0]):
                    best = (gain, f, float(cut))
    if best is None:
        out.append((SHRINKAGE * g / (h + 1), path))
        return
    _, f, cut = best
    _split([c for c in cells if c[0][f] <= cut], depth - 1, (*path, (f, False, cut)), out)
    _split([c for c in cells if c[0][f] > cut], depth - 1, (*path, (f, True, cut)), out)


def boost(cells: list[tuple[Sequence[float], int, int]]) -> tuple[float, list[tuple[float, Path]], Callable[[Sequence[float]], float]]:
    """Logistic boosting on cells (features, rows, positive rows): the start, the leaves of all trees, the score of a cell."""
    rows, ones = sum(n for _, n, _ in cells), sum(s for _, _, s in cells)
    start = math.log((ones + 1) / (rows - ones + 1))
    score = [start] * len(cells)
    leaves: list[tuple[float, Path]] = []
    for _ in range(TREES if 0 < ones < rows else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        tree: list[tuple[float, Path]] = []
        _split([(x, n, s - n * q, n * q * (1 - q)) for (x, n, s), q in zip(cells, p, strict=True)], DEPTH, (), tree)
        for i, (x, _, _) in enumerate(cells):
            score[i] += sum(value for value, path in tree if _holds(x, path))
        leaves += tree
    return start, leaves, lambda x: start + sum(value for value, path in leaves if _holds(x, path))
