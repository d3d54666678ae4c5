"""Batch scoring: requests in, one result row per requested key out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.lookup import answered, looked_up
from clickloom.plans.training import score
from clickloom.schemas import FEATURE_COLUMNS, FEATURE_KEY_COLUMNS
from clickloom.session import stored

# Fixed value: the error of a request with an unknown key.
NOT_FOUND = "Features not found"

# Weights of the plain linear scorer, a stand-in for a model where a result has
# to be repeatable to the digit.
LINEAR_WEIGHTS = {"price": 0.001, "event_weekday": 0.1, "activity_count": 0.05}
CATEGORY_WEIGHTS = {"brand": 0.01, "category_code_level1": 0.02, "category_code_level2": 0.0001}


def linear_score(columns: dict[str, float] = LINEAR_WEIGHTS) -> Column:
    """z / (1 + z) of the weighted sum z of non-negative features."""
    z = sum((F.col(c) * w for c, w in columns.items()), F.lit(0.0))
    return z / (1 + z)


def model_scorer(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """Scores with a trained model: the purchase probability as `prediction`."""
    return lambda inputs: score(model, inputs, "purchase_probability").withColumnRenamed(
        "purchase_probability", "prediction"
    )


def batch_score(
    requests: DataFrame,
    features: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """(request_id, key, prediction, success, error).

    `features` holds the six prepared inputs per key and `scorer` adds a column
    `prediction`. A request with a missing key gives no predictions at all.
    """
    known = features.select(*FEATURE_KEY_COLUMNS, *FEATURE_COLUMNS)
    met = answered(stored(looked_up(requests, known), "looked-up"))
    inputs = met.fillna(0.0, subset=FEATURE_COLUMNS)
    scored = scorer(inputs)
    ok = F.col("batch_ok")
    return scored.select(
        "request_id",
        *FEATURE_KEY_COLUMNS,
        F.when(ok, F.col("prediction")).alias("prediction"),
        ok.alias("success"),
        F.when(~ok, F.lit(NOT_FOUND)).alias("error"),
    )


def status_counts(results: DataFrame) -> DataFrame:
    """Requests and scored keys per outcome."""
    per_request = results.groupBy("request_id", "success").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("prediction").alias("total")
    )
    return per_request.groupBy("success").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("keys").alias("keys"),
        F.round(F.sum("total"), 4).alias("score_total"),
    )
