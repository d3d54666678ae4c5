"""Classification metrics as plain aggregates over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordered import running_totals, totals_by_group

CLIP = 1e-15


def classification_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(metric, value): logloss, error, rmse, mae, auc and accuracy.

    Rows are folded to distinct scores first. AUC is the share of
    (positive, negative) pairs in the right order, ties counting half, taken
    from a running total of negatives over the scores.
    """
    ranked = running_totals(_by_score(scored, [], label, score), ["p"], ["neg"])
    return _measured(ranked, [])


def classification_metrics_by(
    scored: DataFrame, by: Sequence[str], label: str, score: str
) -> DataFrame:
    """(by, metric, value): the same of every group. Groups of any size and number are
    ranked at once."""
    ranked = totals_by_group(_by_score(scored, by, label, score), by, ["p"], ["neg"])
    return _measured(ranked, by)


def _by_score(scored: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    y = F.col(label).cast("double")
    return scored.groupBy(*by, F.col(score).alias("p")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )


def _measured(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    p, pos, neg = F.col("p"), F.col("pos"), F.col("neg")
    n = pos + neg
    clipped = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    wrong = F.when(p > 0.5, neg).otherwise(pos)
    sums = ranked.groupBy(*by).agg(
        F.sum(n).alias("n"),
        F.sum(pos).alias("pos"),
        F.sum(neg).alias("neg"),
        F.sum(-pos * F.log(clipped) - neg * F.log(1 - clipped)).alias("logloss"),
        F.sum(wrong).alias("error"),
        F.sum(pos * (1 - p) * (1 - p) + neg * p * p).alias("squared"),
        F.sum(pos * F.abs(1 - p) + neg * F.abs(p)).alias("absolute"),
        F.sum(pos * (F.col("neg_before") + neg / 2)).alias("ordered"),
    )
    pairs = F.col("pos") * F.col("neg")
    return sums.select(
        *by,
        (F.col("logloss") / F.col("n")).alias("logloss"),
        (F.col("error") / F.col("n")).alias("error"),
        F.sqrt(F.col("squared") / F.col("n")).alias("rmse"),
        (F.col("absolute") / F.col("n")).alias("mae"),
        F.when(pairs > 0, F.col("ordered") / pairs).alias("auc"),
        (1 - F.col("error") / F.col("n")).alias("accuracy"),
    ).unpivot(list(by), ["logloss", "error", "rmse", "mae", "auc", "accuracy"], "metric", "value")
