"""Sessions on a stream, with Spark's own session window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.sessions import SESSION_GAP_SECONDS

#: How often a batch starts.
TRIGGER = "30 seconds"


def stream_sessions(
    events: DataFrame,
    lateness: str,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """(user, start, end, events) of each session once the watermark closes it. Events
    without user have no session.

    The time column must be a timestamp with zone. Two events exactly a gap apart are of
    one session, as in batches. Sessions merge inside each
    input partition before the shuffle when
    spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition is on.
    """
    return (
        events.withWatermark(ts, lateness)
        .groupBy(user, F.session_window(ts, f"{gap_seconds} seconds 1 microsecond"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            F.count(user).alias("known"),
        )
        # not by the user itself: that filter would move below the watermark, which rows
        # without user bring on like others
        .where("known > 0")
        .drop("session_window", "known")
    )


def write_sessions(
    events: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: int = SESSION_GAP_SECONDS,
    drain: bool = False,
) -> StreamingQuery:
    """Appends each closed session to files below `path`, once; with `drain` it handles
    what is there and stops."""
    sessions = stream_sessions(events, lateness, user, ts, gap_seconds)
    writer = (
        sessions.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if drain else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).start()


def closing_event(
    spark: SparkSession,
    events: DataFrame,
    lateness: str,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """One event without user that lies so far behind the last of `events` that the
    watermark it brings closes every session. For the end of a feed that will not go on."""
    last = events.agg(F.max(ts).alias("last"))
    behind = F.expr(f"INTERVAL {lateness}") + F.make_dt_interval(secs=F.lit(gap_seconds + 1))
    names = {f.name: f.dataType for f in events.schema.fields}
    columns = [
        (F.col("last") + behind).cast(kind).alias(name) if name == ts else F.lit(None).cast(kind).alias(name)
        for name, kind in names.items()
    ]
    return last.select(columns)
