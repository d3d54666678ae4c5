"""Keeping joins splittable where one key holds much of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shuffled_apart(df: DataFrame) -> DataFrame:
    """`df`, grouped on its join key, as a side the join shuffles by itself.

    AQE splits a skewed join partition only if both sides come straight from
    the join's own shuffles. A side just aggregated on the join key would be
    joined where it lies, and a hot key on the other side would stay in one
    task. Coalescing to no fewer partitions moves no row but makes Spark forget
    the layout; the price is one shuffle of the aggregated side.

    A frame that is not laid out by a hash, such as a scanned one, is left as it is.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()
    if "hashpartitioning" not in plan.outputPartitioning().toString():
        return df
    conf = df.sparkSession.conf
    usual = conf.get("spark.sql.shuffle.partitions")
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", usual)
    return df.coalesce(max(int(usual), int(first), 2))
