"""Exact running totals over a global order, without one task seeing all rows.

A window without partitions sorts everything in one task. Here rows are range
partitioned, written once so that every reader sees the same slices, totalled
inside each slice, and shifted by the totals of the slices before. Only one row
per slice, at most spark.sql.shuffle.partitions of them, is put in one order.

Callers pass one row per distinct key, so no key fills a slice of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import stored


def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Adds `<value>_before`, the sum of each value over all earlier rows, and
    `<value>_total`, its sum over all rows."""
    ranges = df.repartitionByRange(*order).withColumn("slice", F.spark_partition_id())
    sliced = stored(ranges, "slices")

    in_order = Window.orderBy("slice")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sliced.groupBy("slice").agg(*[F.sum(v).alias(v) for v in values])
    offsets = offsets.select(
        "slice",
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{v}_offset") for v in values],
        *[F.sum(v).over(whole).alias(f"{v}_total") for v in values],
    )
    inside = (
        Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = {
        f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"{v}_offset")
        for v in values
    }
    # Bounded: one row per slice.
    return (
        sliced.join(F.broadcast(offsets), "slice")
        .withColumns(before)
        .drop("slice", *[f"{v}_offset" for v in values])
    )


def totals_by_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """`running_totals` inside each group: one order by group and `order` is cut into
    slices, so a group of any size is spread over them and small ones share one.

    Only one row for each group of a slice is put in order, group by group: at most as
    many as there are slices.
    """
    ranges = df.repartitionByRange(*group, *order).withColumn("slice", F.spark_partition_id())
    sliced = stored(ranges, "slices")
    in_order = Window.partitionBy(*group).orderBy("slice")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sliced.groupBy(*group, "slice").agg(*[F.sum(v).alias(v) for v in values])
    # null is a group, and a join would lose it
    offsets = offsets.select(
        F.col("slice").alias("at_slice"),
        *[F.col(g).alias(f"at_{g}") for g in group],
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{v}_offset") for v in values],
        *[F.sum(v).over(whole).alias(f"{v}_total") for v in values],
    )
    same = F.col("slice") == F.col("at_slice")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"at_{g}"))
    inside = (
        Window.partitionBy("slice", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = {
        f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"{v}_offset")
        for v in values
    }
    joined = sliced.join(offsets, same).withColumns(before)
    return joined.drop("slice", "at_slice", *[f"at_{g}" for g in group], *[f"{v}_offset" for v in values])


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Numbers rows from 1 in a unique order, without gaps."""
    numbered = running_totals(df.withColumn("one", F.lit(1)), order, ["one"])
    return numbered.withColumn(name, (F.col("one_before") + 1).cast("long")).drop(
        "one", "one_before", "one_total"
    )
