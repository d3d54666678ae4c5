"""Keyed feature table fed by a stream.

Each micro-batch writes the latest row of its keys as a run of the store. Writing
a batch again replaces its own run, so a replay changes nothing, and runs are merged
level by level. Readers take the latest row per key over the runs, which also keeps an
older event that arrives late from winning. What can't be used goes below
`batch_id=N` of the quarantine. A batch that fails raises: it is not committed and will
be retried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickloom.plans.features import as_online
from clickloom.schemas import LANDED_DOCUMENT
from clickloom.sources.files import existing, scan_json, with_corrupt
from clickloom.sources.notifications import OBJECT_SCHEME, notified_paths
from clickloom.streaming.landing import quarantined, usable
from clickloom.streaming.store import BUCKETS, STREAM, FeatureStore, newest_per_key

# Fixed value: how often a micro-batch starts.
TRIGGER = "30 seconds"


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def quarantine_of(path: str) -> str:
    """Where the rows that a feature table can't take are put, unless told otherwise."""
    return f"{path.rstrip('/')}_quarantine"


def feature_batch_writer(
    path: str,
    quarantine: str | None = None,
    publish: Callable[[DataFrame, int], None] | None = None,
    buckets: int = BUCKETS,
    stream: str = STREAM,
) -> Callable[[DataFrame, int], None]:
    """The per-batch step: set bad rows aside, keep the latest per key, write.

    Malformed documents and rows without a full key always go to `quarantine`, by
    default the table's sibling. `publish` may push the rows written to an external
    key-value store. `buckets` counts for a new table; `stream` names the checkpoint.
    """
    aside = quarantine or quarantine_of(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            newest = newest_per_key(usable(batch))
            FeatureStore(batch.sparkSession, path, buckets).write(newest, batch_id, stream)
            write_batch(quarantined(batch), batch_id, aside)
            if publish:
                publish(as_online(newest), batch_id)
        finally:
            batch.unpersist()

    return write


def stream_features(
    events: DataFrame,
    path: str,
    checkpoint: str,
    quarantine: str | None = None,
    publish: Callable[[DataFrame, int], None] | None = None,
    drain: bool = False,
    buckets: int = BUCKETS,
    stream: str = STREAM,
) -> StreamingQuery:
    """Runs the feature load; with `drain` it handles what is there and stops."""
    write = feature_batch_writer(path, quarantine, publish, buckets, stream)
    writer = (
        events.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if drain else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).start()


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Latest row per key over all batches: the offline feature table."""
    return FeatureStore(spark, path).read()


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All rows set aside from the feature table at `path`, or below `path` itself."""
    return spark.read.schema(with_corrupt(LANDED_DOCUMENT)).parquet(f"{path}/batch_id=*")


def compact_features(spark: SparkSession, path: str, target: str, buckets: int = BUCKETS) -> None:
    """All batches as one run of a new table at `target`, where a stream may go on
    writing, under the same name from its checkpoint; also to change the buckets."""
    FeatureStore(spark, target, buckets).replace(read_features(spark, path))


def notified_batch_writer(
    write: Callable[[DataFrame, int], None], absent: str, scheme: str = OBJECT_SCHEME
) -> Callable[[DataFrame, int], None]:
    """Per-batch step for notifications: `write` gets the events of the objects that a
    batch names.

    A file scan is planned on the driver, so it needs the names there; their
    number is bounded by the notification source's cap per trigger. Objects that are
    gone by then would fail each retry of the batch: their names are written below
    `absent`, and the others are loaded. Where nothing else needs the notifications,
    streaming the landing folder itself is cheaper.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        named = {row.s3_path for row in notified_paths(batch, scheme=scheme).distinct().toLocalIterator()}
        present = existing(spark, named)
        gone = [(path,) for path in sorted(named - present)]
        write_batch(spark.createDataFrame(gone, "s3_path string"), batch_id, absent)
        if present:
            write(scan_json(spark, sorted(present), LANDED_DOCUMENT, keep_corrupt=True), batch_id)

    return load
