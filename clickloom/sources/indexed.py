"""Parquet laid out for lookups: what secondary indexes do elsewhere.

Rows are put in an order in which the hashed slots of several columns are interleaved bit
by bit, and cut into files along it. A file then holds few slots of each column,
so that for a lookup by any one of them most row groups hold nothing: their Bloom filters, or their
dictionaries where a column has few values, say so before they are read. A value
that many rows have is spread by the other columns, so it fills no task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of each column's slot. More files than 2 ** (columns * BITS) would not differ.
BITS = 10


def interleaved(columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row: its columns' slots, the first bit of each, then the second.
    A missing value has a slot like any other."""
    slots = [F.pmod(F.xxhash64(c), F.lit(1 << bits)) for c in columns]
    place = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for slot in slots:
            place = F.shiftleft(place, 1) + F.shiftright(slot, bit).bitwiseAND(F.lit(1))
    return place


def clustered(
    df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = (), files: int | None = None
) -> DataFrame:
    """`df` in the interleaved order of `columns`, within `partition_by`."""
    place = "_place"
    rows = df.withColumn(place, interleaved(columns))
    order = [*partition_by, place]
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop(place)


def write_indexed(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    lookup_by: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    row_group_bytes: int | None = None,
) -> None:
    """Writes `df` clustered, with a Bloom filter for each column of `lookup_by`, by
    default those it is clustered by. Filters are sized by what a row group holds."""
    writer = clustered(df, cluster_by, partition_by, files).write
    for column in lookup_by if lookup_by is not None else cluster_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
