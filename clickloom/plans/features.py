"""The training frame: one row per event with its features and label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import (
    category_head_tail,
    feature_key,
    nan_to_null,
    weekday,
)
from clickloom.operators.encode import fill_categories
from clickloom.operators.median import exact_median
from clickloom.operators.sessions import with_session_counts
from clickloom.operators.skew import shuffled_apart
from clickloom.operators.upsert import latest_per_key
from clickloom.schemas import (
    FEATURE_COLUMNS,
    FEATURE_KEY_COLUMNS,
    ID_COLUMNS,
    LABEL,
    ONLINE_FIELDS,
)


def event_features(events: DataFrame, purchase_type: str = "purchase") -> DataFrame:
    """Weekday, category levels, session activity and the purchase label."""
    events = _with_activity(events)
    return _with_features(events, purchases(events, purchase_type))


def latest_features(
    events: DataFrame,
    order: Sequence[str] = ("event_timestamp", "event_id"),
    purchase_type: str = "purchase",
) -> DataFrame:
    """The features of the newest event per (user, product, session).

    Activity and label belong to the session, not to the event, so the newest
    events are picked first and only those few rows are joined with the label.
    """
    events = _with_activity(events)
    newest = latest_per_key(events, FEATURE_KEY_COLUMNS, order)
    return _with_features(newest, purchases(events, purchase_type))


def purchases(events: DataFrame, purchase_type: str) -> DataFrame:
    """The (session, product) pairs that ended in a purchase.

    Read from the purchase rows alone; a window over session and product would
    order every event instead.
    """
    return (
        events.where(F.col("event_type") == purchase_type)
        .select("user_session", "product_id")
        .distinct()
        .withColumn("bought", F.lit(1))
    )


def _with_activity(events: DataFrame) -> DataFrame:
    return events if "events_in_session" in events.columns else with_session_counts(events)


def _with_features(events: DataFrame, bought: DataFrame) -> DataFrame:
    level1, level2 = category_head_tail(F.col("category_code"))
    return events.join(shuffled_apart(bought), ["user_session", "product_id"], "left").select(
        "event_id",
        "event_timestamp",
        "user_id",
        "product_id",
        "user_session",
        F.col("price").cast("double").alias("price"),
        "brand",
        level1.alias("category_code_level1"),
        level2.alias("category_code_level2"),
        weekday(F.col("event_timestamp")).alias("event_weekday"),
        F.col("events_in_session").alias("activity_count"),
        F.coalesce("bought", F.lit(0)).alias(LABEL),
    )


def category_columns(events: DataFrame) -> DataFrame:
    """The category features alone, for learning and applying a mapping."""
    level1, level2 = category_head_tail(F.col("category_code"))
    return events.select(
        "event_id",
        "brand",
        weekday(F.col("event_timestamp")).alias("event_weekday"),
        level1.alias("category_code_level1"),
        level2.alias("category_code_level2"),
    )


def training_projection(
    features: DataFrame, columns: Sequence[str] = (*FEATURE_COLUMNS, LABEL)
) -> DataFrame:
    """Any list of columns; the price as a double."""
    return features.select(
        *[F.col(c).cast("double").alias(c) if c == "price" else F.col(c) for c in columns]
    )


def filter_features(features: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Without the id columns, the label last."""
    left_out = {*ID_COLUMNS, *also, LABEL}
    return features.select(*[c for c in features.columns if c not in left_out], LABEL)


def fill_missing(features: DataFrame, median: DataFrame | None = None) -> DataFrame:
    """Missing categories become 'unknown', a missing price the median price,
    which may be given as a one-row frame."""
    return fill_price(fill_categories(features), median)


def fill_price(features: DataFrame, median: DataFrame | None = None) -> DataFrame:
    middle = (exact_median(features, "price") if median is None else median).scalar()
    price = F.coalesce(nan_to_null(F.col("price").cast("double")), middle)
    return features.withColumn("price", price)


def as_online(latest: DataFrame) -> DataFrame:
    """The keyed table scoring reads: one row per key, every field as text."""
    key = feature_key(*[F.col(c) for c in FEATURE_KEY_COLUMNS])
    return latest.select(
        key.alias("feature_key"),
        *[F.col(c).cast("string").alias(c) for c in ONLINE_FIELDS],
    ).where(F.col("feature_key").isNotNull())


def in_test_set(key: Sequence[str], test_size: float = 0.2, seed: int = 42) -> Column:
    """Same answer for a row in every run, whatever the partitioning.

    A hash of the key, not rand(): a recomputed task must not move rows between
    the sets. MD5 so that any other engine can repeat the split.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return draw < int(test_size * 2**32)


def train_test_split(
    frame: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    flag = in_test_set(key, test_size, seed)
    return frame.where(~flag), frame.where(flag)
