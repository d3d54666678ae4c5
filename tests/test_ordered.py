import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from clickloom.operators.median import exact_median
from clickloom.operators.metrics import classification_metrics
from clickloom.operators.ordered import running_totals


def test_running_totals(spark):
    rows = [(i, (i * 37) % 11) for i in range(1000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    found = {r.k: r.v_before for r in running_totals(df, ["k"], ["v"]).collect()}
    total = 0
    for k, v in sorted(rows):
        assert found[k] == total
        total += v


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert running_totals(df, ["k"], ["v"]).count() == 0


@pytest.mark.parametrize(
    "prices, expected",
    [
        ([1.0, 2.0, 3.0, 10.0, None, math.nan], 2.5),
        ([5.0], 5.0),
        ([2.0, 1.0], 1.5),
        ([3.0, 3.0, 3.0, 9.0], 3.0),
        ([-1.0, -5.0, 4.0], -1.0),
        ([None], None),
        ([], None),
    ],
)
def test_median(spark, prices, expected):
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    assert exact_median(df, "price").first()[0] == expected


def test_median_with_a_hot_value_and_weights(spark):
    draw = random.Random(3)
    prices = [7.25] * 500 + [round(draw.uniform(0, 100), 2) for _ in range(1001)]
    df = spark.createDataFrame([(p,) for p in prices], "price double").repartition(6)
    assert exact_median(df, "price").first()[0] == statistics.median(prices)
    folded = df.groupBy("price").agg(F.count("*").alias("w"))
    assert exact_median(folded, "price", weight="w").first()[0] == statistics.median(prices)


def _metrics_by_hand(rows):
    n = len(rows)
    clip = [(y, min(max(p, 1e-15), 1 - 1e-15)) for y, p in rows]
    pos = [p for y, p in rows if y]
    neg = [p for y, p in rows if not y]
    pairs = [(a > b) + 0.5 * (a == b) for a in pos for b in neg]
    error = sum((p > 0.5) != bool(y) for y, p in rows) / n
    return {
        "logloss": -sum(math.log(p) if y else math.log(1 - p) for y, p in clip) / n,
        "error": error,
        "rmse": math.sqrt(sum((y - p) ** 2 for y, p in rows) / n),
        "mae": sum(abs(y - p) for y, p in rows) / n,
        "auc": sum(pairs) / len(pairs) if pairs else None,
        "accuracy": 1 - error,
    }


@pytest.mark.parametrize("kind", ["mixed", "ties", "extremes", "one_class"])
def test_classification_metrics(spark, kind):
    draw = random.Random(kind)
    score = {
        "mixed": lambda: draw.random(),
        "ties": lambda: draw.choice([0.2, 0.5, 0.5, 0.9]),
        "extremes": lambda: draw.choice([0.0, 1.0, 0.5]),
        "one_class": lambda: draw.random(),
    }[kind]
    rows = [(0 if kind == "one_class" else draw.randint(0, 1), score()) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, p double").repartition(5)
    found = {r.metric: r.value for r in classification_metrics(df, "y", "p").collect()}
    for name, value in _metrics_by_hand(rows).items():
        assert found[name] == (value if value is None else pytest.approx(value, abs=1e-9)), name


def test_approximate_median_is_near_the_middle(spark):
    import bisect
    import random

    from clickloom.operators.median import approximate_median

    draw = random.Random(1)
    values = sorted(draw.lognormvariate(0, 2) for _ in range(100_000))
    rows = [(v,) for v in values] + [(None,), (float("nan"),)] * 50_000
    df = spark.createDataFrame(rows, "v double").repartition(16)
    found = approximate_median(df, "v").first()[0]
    assert found in values and abs(bisect.bisect(values, found) / len(values) - 0.5) < 0.02
    plan = approximate_median(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_kll_sketch_agg_double") == 1
    assert approximate_median(df.where("v < 0"), "v").first()[0] is None
    assert approximate_median(spark.createDataFrame([(3.5,)], "v double"), "v").first()[0] == 3.5
