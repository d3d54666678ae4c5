"""Feature lookup for scoring requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import number_or_zero
from clickloom.operators.skew import shuffled_apart
from clickloom.schemas import FEATURE_COLUMNS, FEATURE_KEY_COLUMNS


def feature_lookup(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Each requested key with its features, `found` and `batch_ok`."""
    return answered(looked_up(requests, features))


def looked_up(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Each requested key with its features and `found`."""
    known = shuffled_apart(features.withColumn("found", F.lit(True)))
    met = requests.join(known, FEATURE_KEY_COLUMNS, "left")
    return met.withColumn("found", F.coalesce("found", F.lit(False)))


def answered(met: DataFrame) -> DataFrame:
    """Adds `batch_ok` to keys that were looked up: one missing key fails the whole
    request, as a request is answered as a whole.

    The failed requests are read off the missing keys by a distinct, not by a window, so
    a huge request never lands in one task. `met` is read twice; stored before, its join
    runs once.
    """
    failed = (
        met.where(~F.col("found")).select("request_id").distinct().withColumn("failed", F.lit(True))
    )
    return (
        met.join(shuffled_apart(failed), "request_id", "left")
        .withColumn("batch_ok", F.col("failed").isNull())
        .drop("failed")
    )


def numeric_features(features: DataFrame) -> DataFrame:
    """The six model inputs read from stored text; what is no number is 0.0."""
    present = set(features.columns)
    return features.withColumns(
        {
            c: number_or_zero(F.col(c).cast("string")) if c in present else F.lit(0.0)
            for c in FEATURE_COLUMNS
        }
    )
