"""Connected components of a graph of any size, as joins and aggregations.

Each round hangs the larger neighbours of a node, then its smaller ones, on the
smallest node seen (alternating stars). A node with most of the edges is folded
by a minimum, which combines on the map side, and joined where AQE can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.skew import shuffled_apart
from clickloom.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of `edges` (a, b) that is not the smallest
    of its component.

    Nulls and loops are ignored, repeated edges count once, no edges give no row.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    links = edges.filter("a <> b").select(high.alias("high"), low.alias("low")).distinct()
    links = stored(links, "links")
    mark = _mark(links)
    while mark[0]:
        links = stored(_lower_stars(_upper_stars(links)), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.select(F.col("high").alias("node"), F.col("low").alias("component"))


def _mark(links: DataFrame) -> tuple:
    value = F.xxhash64("high", "low").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(value)).first())


def _upper_stars(links: DataFrame) -> DataFrame:
    """Every larger neighbour moves to the smallest node next to its smaller one."""
    least = (
        links.groupBy("high").agg(F.min("low").alias("least")).withColumnRenamed("high", "low")
    )
    moved = links.join(shuffled_apart(least), "low", "left")
    return moved.select("high", F.coalesce("least", "low").alias("low"))


def _lower_stars(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of these."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    joined = links.join(shuffled_apart(least), "high")
    ends = F.array(
        F.struct(F.col("high").alias("high"), F.col("least").alias("low")),
        F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
    )
    return joined.select(F.inline(ends)).filter("high <> low").distinct()
