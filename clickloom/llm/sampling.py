"""Bounded samples of labelled rows, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_UNITS = 1_000_000


def class_counts(rows: DataFrame, label: str, classes: int | None = None) -> dict:
    """Rows of each label, or of the `classes` most frequent (ties: smaller first)."""
    counted = rows.filter(F.col(label).isNotNull()).groupBy(label).count()
    most = counted.orderBy(F.desc("count"), label)
    most = most if classes is None else most.limit(classes)
    return {r[label]: r["count"] for r in most.collect()}


def bounded_sample(rows: DataFrame, label: str, counts: dict, each: int, by: list[str]) -> DataFrame:
    """About `each` rows of every class in `counts`, all of a smaller class, and in
    total no more than `each` for every class. Which ones, a hash of `by` decides."""
    place = F.xxhash64(*by)
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col(label) == F.lit(value), min(1.0, 0.95 * each / count)).otherwise(share)
    drawn = rows.withColumn("sample_place", place).filter(
        F.pmod("sample_place", F.lit(_UNITS)) < share * _UNITS
    )
    ordered = drawn.orderBy("sample_place").limit(max(1, each * len(counts)))
    return ordered.drop("sample_place")


def sample_of_each(rows: DataFrame, label: str, counts: dict, each: int, by: list[str]) -> DataFrame:
    """About `each` rows of every class in `counts`, all of a smaller class, and no more
    than `each` of any. Which ones, a hash of `by` decides; copies in `by` are drawn
    together, so it should tell rows apart."""
    # a map, as a condition for each of many classes would nest too deep
    shares = [F.lit(v) for value, count in counts.items() for v in (value, min(1.0, 0.95 * each / count))]
    share = F.coalesce(F.element_at(F.create_map(*shares), F.col(label)), F.lit(0.0))
    drawn = rows.withColumn("sample_place", F.xxhash64(*by)).filter(
        F.pmod("sample_place", F.lit(_UNITS)) < share * _UNITS
    )
    order = Window.partitionBy(label).orderBy("sample_place")
    ranked = drawn.withColumn("sample_rank", F.row_number().over(order))
    return ranked.filter(F.col("sample_rank") <= each).drop("sample_place", "sample_rank")
