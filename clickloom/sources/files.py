"""File scans and writes: CSV, JSON documents and partitioned parquet."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import LANDED_EVENT

# Fixed value: how a timestamp is written into a JSON document.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
CORRUPT = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a given schema, so no pass is spent on inference."""
    return spark.read.schema(schema).option("header", True).csv(path)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the types `schema` gives them; what does not fit is null.

    For files whose columns come in any order: matched by name, others kept.
    """
    known = [f for f in schema.fields if f.name in rows.columns]
    return rows.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in known})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def scan_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = LANDED_EVENT,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON documents with a given schema; a malformed field reads as null.

    With `keep_corrupt` the text of a malformed document is kept beside it.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = with_corrupt(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    paths = paths if isinstance(paths, str) else list(paths)
    return reader.schema(schema).json(paths)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def to_documents(
    rows: DataFrame, timestamp: str = "event_timestamp", keep: Sequence[str] = ()
) -> DataFrame:
    """One JSON text per row, the timestamp written to the second.

    Columns in `keep`, such as a row number, stay beside the document.
    """
    written = rows.withColumn(timestamp, F.date_format(timestamp, TIMESTAMP_TEXT))
    fields = [c for c in rows.columns if c not in keep]
    return written.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def write_documents(
    rows: DataFrame, path: str, rows_per_file: int = 100_000, timestamp: str = "event_timestamp"
) -> None:
    """JSON lines in files of a useful size; a file per row would drown any store."""
    documents = to_documents(rows, timestamp)
    documents.write.option("maxRecordsPerFile", rows_per_file).text(path)


def write_by_day(df: DataFrame, path: str, ts: str = "event_timestamp") -> None:
    """Parquet below year=/month=/day=.

    The rebalance hint groups a day's rows into few files and lets AQE split a
    day that holds much of the table over several tasks.
    """
    levels = {"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)}
    parts = df.withColumns(levels).hint("rebalance", *levels)
    parts.write.partitionBy(*levels).parquet(path)


def existing(spark: SparkSession, paths: Iterable[str]) -> set[str]:
    """Those of a bounded number of paths that are there, looked up side by side."""

    def there(path: str) -> bool:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

    paths = list(paths)
    with ThreadPoolExecutor(32) as pool:
        return {path for path, found in zip(paths, pool.map(there, paths)) if found}


class Folder:
    """A folder of any file system that Spark reaches, with few names in it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._at.getFileSystem(spark._jsc.hadoopConfiguration())
        self._child = lambda name: spark._jvm.org.apache.hadoop.fs.Path(self._at, name)

    def names(self) -> list[str]:
        if not self._files.exists(self._at):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._at))

    def create(self, name: str) -> bool:
        """Makes an empty file; False if it is there. Of several that try, one succeeds, as
        far as the file system creates files exclusively."""
        child = self._child(name)
        try:
            if self._files.getUri().getScheme() == "file":  # looks first and then creates
                self._files.mkdirs(self._at)
                local = self._files.pathToFile(child).toPath()
                none = self._jvm.java.lang.reflect.Array.newInstance(
                    self._jvm.java.lang.Class.forName("java.nio.file.attribute.FileAttribute"), 0
                )
                self._jvm.java.nio.file.Files.createFile(local, none)
            else:
                self._files.create(child, False).close()
        except Py4JJavaError as problem:
            if not self._files.exists(child):
                raise problem
            return False
        return True

    def move(self, name: str, target: str) -> None:
        """Renames within the folder; the target must not be there."""
        if not self._files.rename(self._child(name), self._child(target)):
            raise OSError(f"{name} could not become {target}")

    def delete(self, name: str) -> None:
        self._files.delete(self._child(name), True)


@dataclass(frozen=True)
class PartitionedSource:
    """A partitioned feed and the values of the partitions to read of it."""

    root: str
    prefix: dict[str, object]

    def scan(self, spark: SparkSession) -> DataFrame:
        """Only the matching partition folders are listed and read. Without a value
        for any partition column the whole feed would be read, which is refused."""
        feed = spark.read.parquet(self.root)
        unknown = set(self.prefix) - set(feed.columns)
        if not self.prefix or unknown:
            raise ValueError(f"partition values needed; not in {self.root}: {sorted(unknown)}")
        return feed.where(reduce(and_, [F.col(c) == F.lit(v) for c, v in self.prefix.items()]))
