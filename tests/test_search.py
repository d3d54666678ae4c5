"""Trials grown together: equal to trees grown one by one, and what they cost."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.plans import search

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table():
    draw = np.random.default_rng(3)
    a, b, c = draw.integers(0, 9, 600), draw.integers(0, 5, 600), draw.integers(0, 30, 600) / 4
    y = ((a > 4) != (b > 2)) ^ (draw.random(600) < 0.1)
    return np.stack([a, b, c], axis=1).astype(float), y.astype(float)


@pytest.fixture(scope="module")
def frame(spark, table):
    x, y = table
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int").cache()


def by_hand(x, y, trial, rounds):
    """One model with plain numpy, row by row."""
    margin = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def grow(rows, depth):
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (trial.gamma, None)
            if depth < trial.max_depth:
                for k in range(3):
                    for cut in sorted(set(x[rows, k]))[:-1]:
                        left = rows[x[rows, k] <= cut]
                        gl, hl = g[left].sum(), h[left].sum()
                        gr, hr = gs - gl, hs - hl
                        if min(hl, hr) < trial.min_child_weight:
                            continue
                        gain = (gl**2 / (hl + 1) + gr**2 / (hr + 1) - gs**2 / (hs + 1)) / 2
                        if gain > best[0] + 1e-9:
                            best = (gain, k, cut)
            if best[1] is None:
                margin[rows] += -gs / (hs + 1) * trial.learning_rate
            else:
                under = x[rows, best[1]] <= best[2]
                grow(rows[under], depth + 1)
                grow(rows[~under], depth + 1)

        grow(np.arange(len(y)), 0)
    p = 1 / (1 + np.exp(-margin))
    return math.sqrt(((y - p) ** 2).mean())


TRIALS = [
    search.Trial(max_depth=1, learning_rate=0.5),
    search.Trial(max_depth=3, learning_rate=0.3),
    search.Trial(max_depth=4, learning_rate=0.1, min_child_weight=5.0, gamma=0.2),
    search.Trial(max_depth=2, learning_rate=1.0, gamma=1e6),
]


@pytest.mark.parametrize("rounds", [1, 3])
def test_trials_equal_trees_grown_by_hand(frame, table, rounds):
    cells, ends = search.binned(frame, FEATURES, "y", ["id"])
    assert ends["a"] == sorted(set(table[0][:, 0]))
    found = search.grown(cells, FEATURES, TRIALS, rounds)
    for trial, error in zip(TRIALS, found):
        assert error == pytest.approx(by_hand(*table, trial, rounds), abs=1e-9)
    alone = [search.grown(cells, FEATURES, [t], rounds)[0] for t in TRIALS]
    assert alone == pytest.approx(found, abs=1e-12)


def test_all_trials_share_a_pass(spark, frame, monkeypatch):
    cells, _ = search.binned(frame, FEATURES, "y", ["id"])
    passes = []
    gradients = search._gradients
    monkeypatch.setattr(search, "_gradients", lambda *a: passes.append(len(a[2])) or gradients(*a))
    search.grown(cells, FEATURES, TRIALS * 3, 2)
    assert passes == [12] * 8  # one for each level of the deepest tree and round


def test_rows_alike_are_one_cell(spark):
    rows = spark.range(50_000).select(
        (F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), F.lit(1.0).alias("c"), (F.col("id") % 2).alias("y")
    )
    cells, _ = search.binned(rows, FEATURES, "y")
    assert cells.count() == 35 and cells.agg(F.sum("n")).first()[0] == 50_000
    keyed, _ = search.binned(rows.withColumn("id", F.monotonically_increasing_id()), FEATURES, "y", ["id"])
    assert keyed.count() <= 35 * search.SLOTS


def test_many_values_go_by_quantiles(spark):
    rows = spark.range(20_000).select(
        (F.col("id") / 3).alias("a"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 4).alias("b"),
        F.lit(None).cast("double").alias("c"),
        (F.col("id") < 5000).cast("int").alias("y"),
    )
    cells, ends = search.binned(rows, FEATURES, "y", ["a"], bins=16)
    assert len(ends["a"]) == 15 and ends["b"] == [0.0, 1.0, 2.0, 3.0] and ends["c"] == []
    sizes = [r.n for r in cells.groupBy("bin_a").agg(F.sum("n").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * 20_000 / 16
    assert search.grown(cells, FEATURES, [search.Trial(learning_rate=1.0)], 3)[0] < 0.2


def test_no_rows_and_one_class(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 3.0, 1)] * 5, "a double, b double, c double, y int")
    cells, _ = search.binned(rows, FEATURES, "y")
    assert 0 < search.grown(cells, FEATURES, TRIALS[:2])[0] < 0.5
    none, _ = search.binned(rows.limit(0), FEATURES, "y")
    assert all(math.isnan(e) for e in search.grown(none, FEATURES, TRIALS[:2]))


def test_sampled_trials_differ_and_repeat(frame):
    cells, _ = search.binned(frame, FEATURES, "y", ["id"])
    half = search.Trial(max_depth=3, learning_rate=0.5, subsample=0.5)
    some = search.Trial(max_depth=3, learning_rate=0.5, columns=0.4, seed=3)
    whole = search.Trial(max_depth=3, learning_rate=0.5)
    found = search.grown(cells, FEATURES, [half, some, whole], 2)
    assert len(set(found)) == 3 and found[2] == min(found)
    assert found == search.grown(cells, FEATURES, [half, some, whole], 2)
