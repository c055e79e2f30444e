"""Gradient-boosted trees of depth two over small integer features, fitted by DataFrame aggregations.

The training table holds distinct feature vectors with their counts, so its size depends on the number
of bins and not on the data. A level of a tree is one aggregation of gradients by (node, feature, bin);
only that histogram reaches the driver, which picks the splits. Predictions are one Spark expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tree:
    """Split of the root, one for each side, and the values of the four leaves; a split is (feature, last
    bin that goes left)."""

    root: tuple[int, int]
    sides: tuple[tuple[int, int], tuple[int, int]]
    leaves: tuple[float, float, float, float]

    def value(self, bins: Column) -> Column:
        left = lambda split: F.get(bins, F.lit(split[0])) <= split[1]
        pair = lambda i: F.when(left(self.sides[i]), self.leaves[2 * i]).otherwise(self.leaves[2 * i + 1])
        return F.when(left(self.root), pair(0)).otherwise(pair(1))


@dataclass(frozen=True)
class Boosted:
    base: float
    trees: tuple[Tree, ...]

    def margin(self, bins: Column) -> Column:
        return sum((t.value(bins) for t in self.trees), F.lit(self.base))

    def score(self, bins: Column) -> Column:
        return 1 / (1 + F.exp(-self.margin(bins)))


def _histogram(rows: DataFrame, model: Boosted, node: Column) -> dict[int, dict[tuple[int, int], tuple[float, float]]]:
    p = model.score(F.col("bins"))
    weighed = rows.select("bins", node.alias("node"), ((p - F.col("label")) * F.col("n")).alias("g"), (p * (1 - p) * F.col("n")).alias("h"))
    summed = (
        weighed.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("node", "feature", "bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    )
    found: dict[int, dict[tuple[int, int], tuple[float, float]]] = {0: {}, 1: {}}
    for r in sorted(summed.collect()):
        found[r["node"]][(r["feature"], r["bin"])] = (r["g"], r["h"])
    return found


def _best_split(histogram: dict[tuple[int, int], tuple[float, float]], shrink: float) -> tuple[tuple[int, int], float, float]:
    """The split of most gain, and the leaf values left and right of it. Ties go to the first."""
    best = (-1.0, (0, 1 << 20), 0.0, 0.0)
    for feature in sorted({f for f, _ in histogram}):
        bins = sorted(b for f, b in histogram if f == feature)
        g, h = (math.fsum(histogram[(feature, b)][i] for b in bins) for i in (0, 1))
        gl = hl = 0.0
        for b in bins:
            gl, hl = gl + histogram[(feature, b)][0], hl + histogram[(feature, b)][1]
            gr, hr = g - gl, h - hl
            gain = gl * gl / (hl + 1) + gr * gr / (hr + 1) - g * g / (h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, (feature, b), -shrink * gl / (hl + 1), -shrink * gr / (hr + 1))
    return best[1], best[2], best[3]


def fit(rows: DataFrame, rounds: int = 5, shrink: float = 0.7) -> Boosted:
    """Fit on (bins, label, n): feature vectors with label 0 or 1 and how often each occurs.

    Without rows of both labels the model is a constant.
    """
    totals = rows.agg(F.sum(F.col("n") * F.col("label")).alias("ones"), F.sum("n").alias("all")).first()
    ones, both = totals["ones"] or 0, totals["all"] or 0
    model = Boosted(math.log((ones + 1) / (both - ones + 1)), ())
    if ones in (0, both):
        return model
    for _ in range(rounds):
        root, _, _ = _best_split(_histogram(rows, model, F.lit(0))[0], shrink)
        by_side = _histogram(rows, model, F.when(F.get("bins", F.lit(root[0])) <= root[1], 0).otherwise(1))
        left, right = (_best_split(by_side[i], shrink) for i in (0, 1))
        tree = Tree(root, (left[0], right[0]), (left[1], left[2], right[1], right[2]))
        model = Boosted(model.base, (*model.trees, tree))
    return model


def thresholds(rows: DataFrame, model: Boosted, group: Column, precision: float) -> dict:
    """By group, the lowest score from which on at least this share of (bins, label, n) is positive;
    none for a group without such a score. Scores are rounded, so the driver sees a bounded table."""
    counted = rows.groupBy(group.alias("group"), F.round(model.score(F.col("bins")), 3).alias("score")).agg(
        F.sum(F.col("n") * F.col("label")).alias("ones"), F.sum("n").alias("all")
    )
    found: dict = {}
    seen: dict = {}
    for r in sorted(counted.collect(), key=lambda r: (r["group"], -r["score"])):
        ones, both = seen.get(r["group"], (0, 0))
        ones, both = ones + r["ones"], both + r["all"]
        seen[r["group"]] = ones, both
        if ones >= precision * both:
            found[r["group"]] = r["score"]
    return found
