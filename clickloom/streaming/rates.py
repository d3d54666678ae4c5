"""Request rates over sliding windows, for tables and for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.upsert import latest_per_key
from clickloom.streaming.features import write_batch

# Window length and slide.
WINDOW_MINUTES = 5
SLIDE_MINUTES = 1


def request_rate(events: DataFrame, ts: str, by: str) -> DataFrame:
    """(window_start, by, rate per second) over every window with an event.

    Events are counted per minute first, and only those counts are copied into
    the windows that contain the minute, so the copies do not grow with traffic.
    """
    minutes = (
        events.groupBy(F.window(ts, f"{SLIDE_MINUTES} minutes").alias("w"), by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(by, "n", F.col("w.start").alias("minute"))
    )
    steps = F.array(*[F.lit(i) for i in range(0, WINDOW_MINUTES, SLIDE_MINUTES)])
    return (
        minutes.select(by, "n", "minute", F.explode(steps).alias("back"))
        .groupBy(
            (F.col("minute") - F.make_dt_interval(mins=F.col("back"))).alias("window_start"), by
        )
        .agg((F.sum("n") / (WINDOW_MINUTES * 60)).alias("rate"))
    )


def count_stream(
    events: DataFrame, ts: str, by: str, lateness: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Keeps the rates of what has arrived so far below `path`, one folder per
    batch with the windows it changed; handles what is there and stops."""
    rates = stream_request_rate(events, ts, by, lateness)
    return (
        rates.writeStream.foreachBatch(lambda batch, n: write_batch(batch, n, path))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rates(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The last rate written for each window."""
    changes = spark.read.parquet(path)
    return latest_per_key(changes, ["window_start", by], ["batch_id"]).drop("batch_id")


def stream_request_rate(events: DataFrame, ts: str, by: str, lateness: str) -> DataFrame:
    """The same over a stream. A window is settled once the watermark, the newest time
    seen less `lateness`, has passed its end; rows that come later than that are not
    counted. Rates are complete if no row is later than `lateness`."""
    window = F.window(ts, f"{WINDOW_MINUTES} minutes", f"{SLIDE_MINUTES} minutes")
    return (
        events.withWatermark(ts, lateness)
        .groupBy(window.alias("w"), by)
        .agg((F.count(F.lit(1)) / (WINDOW_MINUTES * 60)).alias("rate"))
        .select(F.col("w.start").alias("window_start"), by, "rate")
    )

