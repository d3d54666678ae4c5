"""Events that a feed sends more than once, each passed on once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.columns import record_hash

#: How often a batch starts.
TRIGGER = "30 seconds"


def distinct_events(
    events: DataFrame, lateness: str, fields: Sequence[str], ts: str = "event_timestamp"
) -> DataFrame:
    """`events` without those whose `fields` an earlier one had, by the hash of the record.

    The state holds 32 bytes for each record, for as long as `lateness` after the
    record's time: what is sent again later than that, in event time, passes once more,
    and what is itself later than the watermark is dropped by Spark and counted in
    its progress. The time column must be a timestamp with zone.
    """
    keyed = events.withColumn("record_key", F.unhex(record_hash(list(fields))))
    return keyed.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(["record_key"]).drop("record_key")


def write_distinct(
    events: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str,
    fields: Sequence[str],
    drain: bool = False,
) -> StreamingQuery:
    """Appends the distinct events to files below `path`, each batch once; with `drain` it
    handles what is there and stops."""
    writer = (
        distinct_events(events, lateness, fields)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if drain else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).start()
