"""Exact median of a column of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import nan_to_null
from clickloom.operators.ordered import running_totals


def exact_median(
    df: DataFrame, column: str, name: str = "median", weight: str | None = None
) -> DataFrame:
    """One row with the interpolated median; nulls and NaN do not count.

    Spark's own `median` merges every distinct value into one task's hash map.
    Here the values are counted per distinct value, ranked by running totals,
    and only the one or two values at the middle ranks leave the cluster's tasks.
    With `weight`, a row stands for that many rows.
    """
    value = nan_to_null(F.col(column).cast("double"))
    counts = (
        df.select(value.alias("v"), (F.col(weight) if weight else F.lit(1)).alias("n"))
        .where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.sum("n").alias("n"))
    )
    ranked = running_totals(counts, ["v"], ["n"])
    start, end, total = F.col("n_before"), F.col("n_before") + F.col("n"), F.col("n_total")
    # No more than half of the rows lie before the value, nor after it.
    reaches_middle = (2 * start <= total) & (2 * end >= total)
    return ranked.where(reaches_middle).agg(
        ((F.min("v") + F.max("v")) / 2).alias(name)
    )


#: Size of the sketch: its rank error is about 2.3 / k ** 0.9, with k = 800 some 0.6 per cent.
SKETCH_K = 800


def approximate_median(df: DataFrame, column: str, name: str = "median", k: int = SKETCH_K) -> DataFrame:
    """One row with a value whose rank is close to the middle; nulls and NaN do not count.

    One pass: each task folds its values into a quantile sketch of bounded size, and
    only the sketches meet. The value is one of the column's.
    """
    value = nan_to_null(F.col(column).cast("double"))
    folded = df.select(value.alias("v")).where(F.col("v").isNotNull()).agg(
        F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"), F.count("v").alias("n")
    )
    middle = F.kll_sketch_get_quantile_double("sketch", F.lit(0.5).cast("double"))
    return folded.select(F.when(F.col("n") > 0, middle).alias(name))
