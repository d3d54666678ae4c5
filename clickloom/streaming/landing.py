"""Landed JSON objects as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.schemas import FEATURE_KEY_COLUMNS, LANDED_DOCUMENT
from clickloom.sources.files import CORRUPT, with_corrupt


# Fixed value: how often the next document is landed.
LANDING_INTERVAL = "1 minute"


def landed_events(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """New JSON files below `path`, each read once.

    The checkpoint is the cursor: a file counts as read only when its batch is
    committed. The cap bounds the size of one micro-batch.
    """
    return (
        spark.readStream.schema(with_corrupt(LANDED_DOCUMENT))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )


def copy_to_landing(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    max_files: int = 1,
    drain: bool = False,
) -> StreamingQuery:
    """Moves documents on as they appear, `max_files` files a minute.

    Files are taken by age, and the checkpoint only moves on once a copy is
    complete. With `drain` it copies what is there and stops.
    """
    documents = spark.readStream.option("maxFilesPerTrigger", max_files).text(source)
    writer = (
        documents.writeStream.format("text")
        .option("path", landing)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if drain else {"processingTime": LANDING_INTERVAL}
    return writer.trigger(**trigger).start()


def usable(events: DataFrame) -> DataFrame:
    """Rows a feature key can be built from."""
    return events.where(_complete()).drop(CORRUPT)


def quarantined(events: DataFrame) -> DataFrame:
    """Malformed documents and rows without a full key."""
    return events.where(~_complete())


def _complete():
    ok = F.col(CORRUPT).isNull()
    for name in FEATURE_KEY_COLUMNS:
        ok = ok & F.col(name).isNotNull()
    return ok & F.col("event_timestamp").isNotNull()
