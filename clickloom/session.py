"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are tuned for. AQE sizes the reduce side from what the
# shuffle really wrote and splits skewed join partitions, also where an
# aggregation after the join then needs a shuffle of its own; broadcasts stay
# behind Catalyst's size check.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the recommended settings; `extra` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def handle_skew(spark: SparkSession) -> None:
    """Turns on skew handling in a session somebody else built."""
    for key, value in RECOMMENDED.items():
        if key.startswith("spark.sql.adaptive.") and value == "true":
            spark.conf.set(key, value)


def object_store_options(
    endpoint: str, path_style: bool = True, ssl: bool = True
) -> dict[str, str]:
    """S3A settings for an S3-compatible store.

    Keys are not among them: the default credential provider chain finds them
    on the cluster, so none passes through code.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder, removed when
    the application ends.

    Only a local session may fall back on this machine's temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):  # nor local-cluster
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        base = tempfile.mkdtemp(prefix="clickloom-")
        context.setCheckpointDir(base)
    own = f"{base.rstrip('/')}/clickloom-{context.applicationId}"
    _remove_at_end(spark, own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the scratch folder and read back, for results read several
    times: they are computed once, outlive any executor, and Catalyst knows
    their size."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


def ship_code(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once per application, so that the
    functions that run in tasks can be imported there."""
    context = spark.sparkContext
    if getattr(context, "_clickloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="clickloom-code-")) / "clickloom.zip"
    with zipfile.ZipFile(archive, "w") as content:
        for file in sorted(package.rglob("*.py")):
            content.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))  # Spark's own file server hands it out
    context._clickloom_shipped = True
