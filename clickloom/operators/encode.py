"""Category values to dense indexes, kept as a table and used the same way
for training and for scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.ordered import running_totals
from clickloom.schemas import CATEGORICAL_COLUMNS, FILL_TEXT, UNSEEN_INDEX


def category_mapping(
    frame: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL_COLUMNS)
) -> DataFrame:
    """(col_name, value, idx): sorted distinct values numbered from 0.

    Numeric columns sort as numbers. One pass over the frame covers all columns;
    only distinct values are shuffled.
    """
    numeric = {
        f.name for f in frame.schema.fields if isinstance(f.dataType, T.NumericType)
    }
    entries = []
    for name in columns:
        number = F.col(name).cast("double") if name in numeric else F.lit(None).cast("double")
        entries.append(
            F.struct(
                F.lit(name).alias("col_name"),
                F.col(name).cast("string").alias("value"),
                number.alias("number"),
            )
        )
    values = (
        frame.select(F.inline(F.array(*entries)))
        .where(F.col("value").isNotNull())
        .distinct()
        .withColumn("one", F.lit(1))
    )
    ranked = running_totals(values, ["col_name", "number", "value"], ["one"])
    # Bounded: one row per column.
    starts = ranked.groupBy("col_name").agg(F.min("one_before").alias("start"))
    return ranked.join(F.broadcast(starts), "col_name").select(
        "col_name", "value", (F.col("one_before") - F.col("start")).cast("int").alias("idx")
    )


def save_mapping(mapping: DataFrame, path: str) -> None:
    mapping.write.mode("overwrite").parquet(path)


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The stored mapping. Its files give Catalyst its true size, so a small one
    is broadcast and a large one is shuffled, without a hint."""
    return spark.read.schema("col_name string, value string, idx int").parquet(path)


def encode_categories(
    frame: DataFrame,
    mapping: DataFrame,
    columns: Sequence[str] = tuple(CATEGORICAL_COLUMNS),
) -> DataFrame:
    """Replaces each column by its index; unseen values and nulls become -1."""
    encoded = frame
    for name in columns:
        lookup = mapping.where(F.col("col_name") == name).select(
            F.col("value").alias(f"_{name}_value"), F.col("idx").alias(f"_{name}_idx")
        )
        encoded = (
            encoded.join(lookup, F.col(name).cast("string") == F.col(f"_{name}_value"), "left")
            .withColumn(name, F.coalesce(F.col(f"_{name}_idx"), F.lit(UNSEEN_INDEX)))
            .drop(f"_{name}_value", f"_{name}_idx")
        )
    return encoded


def fill_categories(
    frame: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL_COLUMNS)
) -> DataFrame:
    """Missing text categories become 'unknown', a value of its own. A numeric
    category keeps its type, and its nulls are encoded as unseen."""
    texts = {f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)}
    return frame.fillna(FILL_TEXT, subset=[c for c in columns if c in texts])
