"""Features as a model takes them: one way for training and for scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.columns import nan_to_null
from clickloom.operators.encode import (
    category_mapping,
    encode_categories,
    fill_categories,
    load_mapping,
    save_mapping,
)
from clickloom.operators.median import exact_median
from clickloom.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS

#: What becomes of a missing category: the index of unseen values, or a category
#: of its own named 'unknown'.
NULL_POLICIES = ("unseen", "unknown")
_SETTINGS = "null_policy string, median double"


@dataclass(frozen=True)
class Preparation:
    """What was learned from the training rows: the categories' mapping, the median
    price, and how missing categories are read."""

    mapping: DataFrame
    median: float | None
    null_policy: str

    def apply(self, features: DataFrame) -> DataFrame:
        """`features`, typed or stored as text, with all feature columns as doubles.

        A price that is missing or no number becomes the median, any other number
        that is missing becomes 0.
        """
        frame = _readable(features, self.null_policy)
        frame = encode_categories(frame, self.mapping)
        return frame.withColumns(
            {
                **{c: F.col(c).cast("double") for c in CATEGORICAL_COLUMNS},
                "price": F.coalesce("price", F.lit(self.median), F.lit(0.0)),
                "activity_count": F.coalesce("activity_count", F.lit(0.0)),
            }
        )

    def save(self, folder: str) -> None:
        save_mapping(self.mapping, f"{folder}/mapping")
        spark = self.mapping.sparkSession
        row = [(self.null_policy, self.median)]
        settings = spark.createDataFrame(row, _SETTINGS)
        settings.coalesce(1).write.mode("overwrite").parquet(f"{folder}/settings")


def learn(features: DataFrame, null_policy: str = "unseen") -> Preparation:
    """From the training rows alone. The rows are read twice, so a stored frame
    serves best."""
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy is one of {NULL_POLICIES}, not {null_policy!r}")
    frame = _readable(features, null_policy)
    median = exact_median(frame, "price").first()[0]
    return Preparation(category_mapping(frame), median, null_policy)


def load(spark: SparkSession, folder: str) -> Preparation:
    settings = spark.read.schema(_SETTINGS).parquet(f"{folder}/settings").first()
    mapping = load_mapping(spark, f"{folder}/mapping")
    return Preparation(mapping, settings.median, settings.null_policy)


def _readable(features: DataFrame, null_policy: str) -> DataFrame:
    """Categories as they are, numbers as doubles or null; absent columns are null."""
    absent = [c for c in FEATURE_COLUMNS if c not in features.columns]
    frame = features.withColumns({c: F.lit(None).cast("string") for c in absent})
    numbers = {c: nan_to_null(F.col(c).try_cast("double")) for c in ("price", "activity_count")}
    frame = frame.withColumns({**numbers, "event_weekday": F.col("event_weekday").try_cast("int")})
    return fill_categories(frame) if null_policy == "unknown" else frame
