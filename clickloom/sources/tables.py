"""Catalog tables, inserts and relational scans."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.measure import LoadMeasure
from clickloom.operators.upsert import new_rows

#: Partition values that come to the driver at most.
MOST_PARTITIONS = 1000


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Creates a parquet table unless it is there.

    Partitioning takes the place of secondary indexes: a filter on a partition
    column skips files, and parquet's min/max skip row groups.
    """
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def insert_new(
    spark: SparkSession,
    name: str,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    measure: LoadMeasure | None = None,
) -> None:
    """Appends the rows whose key the table does not hold.

    With `partition_by`, where a record's key fixes its partition, only the
    partitions the new rows belong to are read and compared. A `measure` counts and times
    the load as it runs.
    """
    with measure or nullcontext():
        table = spark.table(name)
        held = touched_partitions(table, incoming, partition_by) if partition_by else table
        incoming = measure.incoming(incoming) if measure else incoming
        added = new_rows(held, incoming, keys, order).select(*table.columns)
        added = measure.written(added) if measure else added
        laid_out(added, partition_by, sort_by).write.insertInto(name)


def touched_partitions(
    table: DataFrame, incoming: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """The part of a partitioned table that rows of `incoming` could be in.

    The incoming values of a partition column become literals of the scan's
    partition filter, so other partitions are not read. A column with more than
    MOST_PARTITIONS incoming values does not narrow the scan.
    """
    for column in partition_by:
        distinct = incoming.select(column).distinct().limit(MOST_PARTITIONS + 1)
        values = [row[0] for row in distinct.collect()]
        if len(values) <= MOST_PARTITIONS:
            table = table.where(F.col(column).isin(values) | F.col(column).isNull())
    return table


def laid_out(
    df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> DataFrame:
    """Rows arranged for a partitioned write.

    The rebalance hint gives a partition few files, and one that holds much of
    the data several tasks. Sorting inside files lets min/max skip row groups.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df


def scan_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel scan of a relational query. Needs the database's driver jar."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", f"({query}) AS q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
    )
    return reader.options(**(options or {})).load()
