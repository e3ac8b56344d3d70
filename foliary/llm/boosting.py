"""Gradient-boosted trees over discrete features, fitted on weighted counts and turned into SQL expressions."""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tree:
    """Two levels of tests `feature <= cut`; four leaf values, (no, no) first."""

    tests: tuple[tuple[str, int], tuple[str, int]]
    leaves: tuple[float, float, float, float]

    def value(self, row: dict) -> float:
        (f, a), (g, b) = self.tests
        return self.leaves[2 * (row[f] <= a) + (row[g] <= b)]

    def column(self, of: Column) -> Column:
        (f, a), (g, b) = self.tests
        low, high = of[f] <= a, of[g] <= b
        return F.when(low, F.when(high, self.leaves[3]).otherwise(self.leaves[2])).otherwise(F.when(high, self.leaves[1]).otherwise(self.leaves[0]))


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]

    def score(self, row: dict) -> float:
        return self.start + sum(t.value(row) for t in self.trees)

    def column(self, of: Column) -> Column:
        out = F.lit(self.start)
        for t in self.trees:
            out = out + t.column(of)
        return out


def fit(rows: list[tuple[dict, float, float]], features: list[str], rounds: int = 12, rate: float = 0.5, ridge: float = 1.0) -> Boosted:
    """rows: (features, positives, negatives) for each distinct vector. Newton steps of logistic loss; ties go to the first test."""
    pos, neg = sum(p for _, p, _ in rows), sum(n for _, _, n in rows)
    start = math.log((pos + 1) / (neg + 1))
    cuts = [(f, c) for f in features for c in sorted({r[f] for r, _, _ in rows})[:-1]]
    pairs = list(itertools.combinations(cuts, 2)) or [(c, c) for c in cuts]
    margin, trees = [start] * len(rows), []
    sides = {c: [r[c[0]] <= c[1] for r, _, _ in rows] for c in cuts}
    for _ in range(rounds if pairs else 0):
        grad, hess = [], []
        for (_, p, n), m in zip(rows, margin, strict=True):
            q = 1 / (1 + math.exp(-m))
            grad.append(p - (p + n) * q)
            hess.append((p + n) * q * (1 - q))
        best = None
        for a, b in pairs:
            g, h = [0.0] * 4, [ridge] * 4
            for x, y, gi, hi in zip(sides[a], sides[b], grad, hess, strict=True):
                g[2 * x + y] += gi
                h[2 * x + y] += hi
            gain = sum(x * x / y for x, y in zip(g, h, strict=True))
            if best is None or gain > best[0] + 1e-12:
                best = (gain, Tree((a, b), tuple(round(rate * x / y, 9) for x, y in zip(g, h, strict=True))))
        trees.append(best[1])
        margin = [m + best[1].value(r) for (r, _, _), m in zip(rows, margin, strict=True)]
    return Boosted(round(start, 9), tuple(trees))


def calibrated(model: Boosted, rows: list[tuple[dict, float, float]], precision: float) -> float:
    """The lowest score at and above which positives have that share of the weight; infinite if there is none."""
    by: dict[float, list[float]] = {}
    for r, p, n in rows:
        x = by.setdefault(round(model.score(r), 6), [0.0, 0.0])
        x[0] += p
        x[1] += n
    best, pos, neg = math.inf, 0.0, 0.0
    for score in sorted(by, reverse=True):
        pos, neg = pos + by[score][0], neg + by[score][1]
        if pos and pos / (pos + neg) >= precision:
            best = score - 1e-6
    return best
