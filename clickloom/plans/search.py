"""Many boosted models at once, grown over one binned matrix.

Features are cut into bins, and rows alike in all bins are one row with a count, so the
matrix that a search reads again and again is as large as the bins' combinations
that occur. A level of the trees of all trials takes one pass: each row adds its
gradients to the bins of the node it lies in, trial by trial, which combines on the map
side; what meets on the driver is one number pair for each trial, node, feature and
bin, whatever the number of rows. The splits are chosen there.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import stored

#: Bins of a feature; one with fewer values has a bin for each.
BINS = 64
#: Shares of the rows that a trial may sample, in parts of the whole.
SLOTS = 20
#: Added to a node's weight, so that small ones are drawn to 0.
PENALTY = 1.0


@dataclass(frozen=True)
class Trial:
    """What a model is grown with. Of the features each tree sees the share `columns`,
    drawn by the seed, or all of `features` if these are named."""

    max_depth: int = 3
    learning_rate: float = 0.3
    min_child_weight: float = 1.0
    subsample: float = 1.0
    columns: float = 1.0
    gamma: float = 0.0
    seed: int = 0
    features: tuple[str, ...] = ()


@dataclass
class _Tree:
    """Nodes are numbered from 1, the children of n being 2n and 2n + 1."""

    splits: dict[int, tuple[str, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def place(self, node: int = 1) -> Column:
        """The node that a row has come to."""
        return self._down(node, lambda n: F.lit(n))

    def value(self) -> Column:
        return self._down(1, lambda n: F.lit(self.values.get(n, 0.0)))

    def _down(self, node: int, end) -> Column:
        if node not in self.splits:
            return end(node)
        name, bin_ = self.splits[node]
        left, right = self._down(2 * node, end), self._down(2 * node + 1, end)
        return F.when(F.col(f"bin_{name}") <= bin_, left).otherwise(right)


def binned(
    rows: DataFrame, features: Sequence[str], label: str, key: Sequence[str] = (), bins: int = BINS
) -> tuple[DataFrame, dict[str, list[float]]]:
    """The matrix (bin_<feature>, slot, n, positives), stored, and the bins' upper ends.

    A bin holds the values up to its end. Missing values lie in the first. The slot, a
    hash of `key`, tells which trials sample a row.
    """
    numbers = {f: F.col(f).cast("double") for f in features}
    ends = _ends(rows.select(*[v.alias(f) for f, v in numbers.items()]), features, bins)
    slot = F.pmod(F.xxhash64(*(key or features)), F.lit(SLOTS)).cast("int")
    cells = (
        rows.select(
            *[_bin(numbers[f], ends[f]).alias(f"bin_{f}") for f in features],
            slot.alias("slot"),
            F.col(label).cast("double").alias("y"),
        )
        .groupBy(*[f"bin_{f}" for f in features], "slot")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"))
    )
    return stored(cells, "cells"), ends


def _ends(rows: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """All values of a feature that has at most `bins`, otherwise quantiles."""
    # bounded: a count and `bins` numbers for each feature
    kinds = rows.agg(*[F.approx_count_distinct(f, 0.02).alias(f) for f in features]).first()
    shares = [k / bins for k in range(1, bins)]
    middle = rows.agg(
        *[F.percentile_approx(f, shares, 100 * bins).alias(f) for f in features if kinds[f] > bins / 2],
        F.lit(0).alias("_"),
    ).first()
    out = {}
    for f in features:
        values = None
        if kinds[f] <= 2 * bins:
            found = rows.select(f).where(F.col(f).isNotNull()).distinct().limit(bins + 1).collect()
            values = sorted(r[0] for r in found) if len(found) <= bins else None
        out[f] = values if values is not None else sorted(set(middle[f]))
    return out


def _bin(value: Column, ends: list[float]) -> Column:
    if not ends:
        return F.lit(0)
    below = F.filter(F.lit([float(e) for e in ends]), lambda end: end < value)
    return F.coalesce(F.size(below), F.lit(0))


def grown(
    cells: DataFrame, features: Sequence[str], trials: Sequence[Trial], rounds: int = 1
) -> list[float]:
    """The root mean squared error over all rows of each trial's model."""
    base = cells.select("*", F.array(*[F.lit(0.0)] * len(trials)).alias("margins"))
    depth = max(t.max_depth for t in trials)
    for number in range(rounds):
        trees = [_Tree() for _ in trials]
        seen = [_columns(t, features, number) for t in trials]
        for level in range(depth):
            found = _gradients(base, features, trials, trees, level)
            _grow(found, trials, trees, seen)
        margins = [F.col("margins")[i] + t.value() for i, t in enumerate(trees)]
        base = stored(base.withColumn("margins", F.array(*margins)), "margins")
    p = [_probability(F.col("margins")[i]) for i in range(len(trials))]
    hits, misses = F.col("positives"), F.col("n") - F.col("positives")
    squared = [F.sum(hits * (1 - x) * (1 - x) + misses * x * x) / F.sum("n") for x in p]
    row = base.agg(*[F.sqrt(s).alias(f"t{i}") for i, s in enumerate(squared)]).first()
    return [math.nan if v is None else v for v in row]


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def _columns(trial: Trial, features: Sequence[str], number: int) -> list[str]:
    if trial.features:
        return list(trial.features)
    draw = random.Random(f"{trial.seed}/{number}")
    n = max(1, int(trial.columns * len(features)))
    return sorted(draw.sample(list(features), n), key=list(features).index)


def _gradients(
    cells: DataFrame, features: Sequence[str], trials: Sequence[Trial], trees: list[_Tree], level: int
) -> dict[tuple[int, int], dict[str, dict[int, tuple[float, float]]]]:
    """Sums of gradients and of weights by (trial, node), feature and bin, of the
    nodes of a level; one pass for all trials."""
    nodes = []
    for i, (trial, tree) in enumerate(zip(trials, trees)):
        p = _probability(F.col("margins")[i])
        sampled = F.col("slot") < round(trial.subsample * SLOTS)
        open_ = (tree.place() >= 2**level) & F.lit(level < trial.max_depth) & sampled
        nodes.append(
            F.when(
                open_,
                F.struct(
                    F.lit(i).alias("trial"),
                    tree.place().alias("node"),
                    (F.col("n") * p - F.col("positives")).alias("g"),
                    (F.col("n") * p * (1 - p)).alias("h"),
                ),
            )
        )
    bins = [
        F.struct(F.lit(k).alias("feature"), F.col(f"bin_{f}").alias("bin")) for k, f in enumerate(features)
    ]
    each = cells.select(F.array(*bins).alias("bins"), F.explode(F.array(*nodes)).alias("at"))
    sums = (
        each.where("at is not null")
        .select("at.*", F.inline("bins"))
        .groupBy("trial", "node", "feature", "bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    )
    out: dict = {}
    # bounded: trials x nodes of a level x features x bins
    for r in sums.collect():
        out.setdefault((r.trial, r.node), {}).setdefault(features[r.feature], {})[r.bin] = (r.g, r.h)
    return out


def _grow(found: dict, trials: Sequence[Trial], trees: list[_Tree], seen: list[list[str]]) -> None:
    """Splits the nodes of a level where that gains, and sets the values of new leaves."""
    for (i, node), by_feature in found.items():
        trial, tree = trials[i], trees[i]
        any_feature = next(iter(by_feature.values()))
        g, h = (sum(x[k] for _, x in sorted(any_feature.items())) for k in (0, 1))
        tree.values.setdefault(node, -g / (h + PENALTY) * trial.learning_rate)
        best = (trial.gamma, None)
        for name in seen[i]:
            bins = sorted(by_feature[name].items())
            sums = np.cumsum([x for _, x in bins], axis=0)
            for (bin_, _), (gl, hl) in zip(bins[:-1], sums[:-1]):
                gr, hr = g - gl, h - hl
                if min(hl, hr) < trial.min_child_weight:
                    continue
                gain = (gl * gl / (hl + PENALTY) + gr * gr / (hr + PENALTY) - g * g / (h + PENALTY)) / 2
                if gain > best[0]:
                    best = (gain, (name, bin_), (gl, hl), (gr, hr))
        if best[1]:
            tree.splits[node] = best[1]
            for child, (cg, ch) in ((2 * node, best[2]), (2 * node + 1, best[3])):
                tree.values[child] = float(-cg / (ch + PENALTY) * trial.learning_rate)
