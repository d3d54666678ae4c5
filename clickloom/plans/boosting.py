"""Boosted ensembles round by round: staged scores, metrics of every round, cutting an
ensemble to its best rounds.

All rounds are scored in one pass. A row's running margin after each tree is an
array; rows are folded to distinct scores of each part and round before anything is
put in order, and trees make few distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.metrics import classification_metrics_by

#: Rounds without gain after which boosting ends, and the metric that gains.
PATIENCE = 5
STOP_METRIC = "logloss"
#: Metrics that gain by rising.
RISING = ("auc", "accuracy")


def staged_scores(
    frame: DataFrame, trees: Sequence[Column], weights: Sequence[float], keep: Sequence[str]
) -> DataFrame:
    """`keep`, step and the probability `p` after the trees up to that step."""
    margins, total = [], F.lit(0.0)
    for tree, weight in zip(trees, weights):
        total = total + F.lit(float(weight)) * tree
        margins.append(total)
    steps = frame.select(*keep, F.posexplode(F.array(*margins)).alias("step", "margin"))
    return steps.select(*keep, "step", (1 / (1 + F.exp(-2 * F.col("margin")))).alias("p"))


def round_metrics(scores: DataFrame, label: str, part: str = "part") -> DataFrame:
    """(part, step, metric, value): every metric of each part after each round, with
    the loss that boosting lowers, twice the log loss."""
    measured = classification_metrics_by(scores, [part, "step"], label, "p")
    loss = measured.where("metric = 'logloss'").select(
        part, "step", F.lit("boosting_loss").alias("metric"), (2 * F.col("value")).alias("value")
    )
    return measured.unionByName(loss)


def stump(feature: str, threshold: float, at_most: float, above: float) -> Column:
    """A tree of one split; a missing value goes to the right, as a large one does."""
    return F.when(F.col(feature) <= threshold, at_most).otherwise(above)


def metrics_by_round(
    model: PipelineModel, sets: dict[str, DataFrame], label: str
) -> DataFrame:
    """(part, step, metric, value) of a fitted pipeline over some sets of rows."""
    assembler, trees = model.stages
    parts = [
        rows.withColumn("part", F.lit(part)).select("part", label, *assembler.getInputCols())
        for part, rows in sets.items()
    ]
    rows = assembler.transform(reduce(DataFrame.unionByName, parts))
    names = [f"_tree_{i}" for i in range(len(trees.treeWeights))]
    for name, tree in zip(names, trees.trees):
        rows = tree.copy({tree.predictionCol: name}).transform(rows)
    scores = staged_scores(rows, [F.col(n) for n in names], trees.treeWeights, ["part", label])
    return round_metrics(scores, label)


def best_step(values: Sequence[float], patience: int = PATIENCE, rising: bool = False) -> tuple[int, bool]:
    """The first step with the best value before `patience` steps without gain, and
    whether these came."""
    best = 0
    for step, value in enumerate(values):
        if (value > values[best]) if rising else (value < values[best]):
            best = step
        elif step - best >= patience:
            return best, True
    return best, False


def best_rounds(
    model: PipelineModel,
    rows: DataFrame,
    label: str,
    metric: str = STOP_METRIC,
    patience: int = PATIENCE,
) -> tuple[int, bool]:
    """How many rounds of the ensemble to keep by the metric of `rows`, and whether
    further rounds are known not to gain. Without rows, or where the metric is not
    defined, all rounds are kept."""
    history = metrics_by_round(model, {"stop": rows}, label).where(F.col("metric") == metric)
    # bounded: one row for each round
    values = {r.step: r.value for r in history.select("step", "value").collect()}
    if not values or any(v is None for v in values.values()):
        return len(model.stages[-1].treeWeights), False
    best, ended = best_step([values[s] for s in sorted(values)], patience, metric in RISING)
    return best + 1, ended


def cut(model: PipelineModel, rounds: int) -> PipelineModel:
    """The pipeline with the first `rounds` trees of its ensemble."""
    assembler, trees = model.stages
    if rounds >= len(trees.treeWeights):
        return model
    context = SparkContext.getOrCreate()
    gateway, jvm = context._gateway, context._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    kept = gateway.new_array(kind, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(trees.trees[:rounds], trees.treeWeights)):
        kept[i], weights[i] = tree._java_obj, weight
    java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        trees.uid, kept, weights, trees.numFeatures, trees.numClasses
    )
    shorter = GBTClassificationModel(java)
    shorter._transfer_params_from_java()
    return PipelineModel([assembler, trees._copyValues(shorter)])
