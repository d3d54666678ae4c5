"""Latest row per key, and inserting only what is not there yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.columns import nan_to_null


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` per key; rows level there are settled by
    the remaining columns, so the result never depends on arrival.

    A maximum combines on the map side: a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest `order` per key."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    oldest = F.min(F.struct(*order, *rest)).alias("oldest")
    return df.groupBy(*keys).agg(oldest).select(*keys, "oldest.*").select(*df.columns)


def new_rows(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Incoming rows whose key is not stored yet, the first per key; NaN is null."""
    doubles = [f.name for f in incoming.schema.fields if isinstance(f.dataType, T.DoubleType)]
    cleaned = incoming.withColumns({c: nan_to_null(F.col(c)) for c in doubles})
    return first_per_key(cleaned, keys, order).join(
        existing.select(*keys), list(keys), "left_anti"
    )


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The table after inserting, leaving rows with a known key alone."""
    added = new_rows(existing, incoming, keys, order)
    return existing.unionByName(added.select(*existing.columns))
