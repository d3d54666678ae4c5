"""Object-created notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.schemas import NOTIFICATION

# Fixed value: scheme in front of an object key.
OBJECT_SCHEME = "s3a://"


def kafka_notifications(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_per_trigger: int = 10_000,
    fail_on_loss: bool = True,
) -> DataFrame:
    """Notification stream. Needs the Kafka connector jar.

    Starts at the earliest offset; the cap per trigger bounds what one micro-batch
    has to plan. Offsets that are gone already fail the stream, unless
    `fail_on_loss` is off: then what they held is skipped.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", str(fail_on_loss).lower())
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .load()
    )


def notified_paths(
    messages: DataFrame, value: str = "value", scheme: str = OBJECT_SCHEME
) -> DataFrame:
    """Object paths named by binary JSON messages.

    Null, malformed and key-less messages and empty keys drop out.
    """
    return (
        messages.select(F.from_json(F.col(value).cast("string"), NOTIFICATION).alias("message"))
        .select(F.col("message.Key").alias("key"))
        .where(F.col("key").isNotNull() & (F.col("key") != ""))
        .select(F.concat(F.lit(scheme), "key").alias("s3_path"))
    )
