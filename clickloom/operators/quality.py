"""Checks and volume metrics, each as a small result table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.schemas import MAX_DUPLICATES, MAX_SECONDS, MAX_TOTAL, MIN_TOTAL


def row_count_check(df: DataFrame, suite: str, bounds: tuple[int, int]) -> DataFrame:
    """Is the number of rows within bounds (both included)?"""
    low, high = bounds
    return df.agg(F.count(F.lit(1)).alias("observed")).select(
        F.lit(suite).alias("suite"),
        F.lit("row_count").alias("check_name"),
        "observed",
        F.lit(low).cast("long").alias("min_value"),
        F.lit(high).cast("long").alias("max_value"),
        F.col("observed").between(low, high).alias("success"),
    )


def load_metrics(
    events: DataFrame, valid: str = "valid", record: str = "record_hash"
) -> DataFrame:
    """(metric, value): total, valid, invalid and duplicate records.

    `record` is a hash in hex; its bytes, half as long, are what is shuffled.
    """
    content = F.unhex(record)
    one_row = events.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(valid)).alias("valid_records"),
        F.count_if(~F.col(valid)).alias("invalid_records"),
        (F.count(record) - F.count_distinct(content)).alias("duplicate_records"),
    )
    names = ["total_records", "valid_records", "invalid_records", "duplicate_records"]
    return one_row.unpivot([], names, "metric", "value")


def load_alerts(metrics: DataFrame) -> DataFrame:
    """(rule, fired); null where the metric a rule needs was not measured."""

    def value(name: str):
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    one_row = metrics.agg(
        value("total_records").alias("total"),
        value("valid_records").alias("valid"),
        value("invalid_records").alias("invalid"),
        value("duplicate_records").alias("duplicates"),
        value("processing_time").alias("seconds"),
    )
    rules = {
        "more_invalid_than_valid": F.col("invalid") > F.col("valid"),
        "many_duplicates": F.col("duplicates") > MAX_DUPLICATES,
        "low_volume": F.col("total") < MIN_TOTAL,
        "high_volume": F.col("total") > MAX_TOTAL,
        "long_processing": F.col("seconds") > MAX_SECONDS,
    }
    rows = [
        F.struct(F.lit(rule).alias("rule"), fired.alias("fired"))
        for rule, fired in rules.items()
    ]
    return one_row.select(F.inline(F.array(*rows)))


def fk_violations(fact: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """(fk_name, violations): rows whose non-null key has no dimension row.

    All keys are checked in one scan and one shuffle: the key values are counted
    first, so a hot key costs one row, and then looked up together.
    """
    keys = [
        F.struct(F.lit(name).alias("fk_name"), F.col(name).cast("string").alias("key"))
        for name in references
    ]
    used = (
        fact.select(F.inline(F.array(*keys)))
        .groupBy("fk_name", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(
                F.lit(name).alias("fk_name"),
                F.col(name).cast("string").alias("key"),
                F.lit(True).alias("known"),
            )
            for name, dim in references.items()
        ],
    )
    missing = F.col("key").isNotNull() & F.col("known").isNull()
    return (
        used.join(known, ["fk_name", "key"], "left")
        .groupBy("fk_name")
        .agg(F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("violations"))
    )


def price_range(df: DataFrame, column: str = "price") -> DataFrame:
    return df.agg(F.min(column).alias("min_price"), F.max(column).alias("max_price"))
