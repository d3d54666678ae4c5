"""The keyed feature table: bucketed by key, merged level by level.

A batch writes the newest row of each of its keys as a run, a folder of its own in a
table bucketed by the key. FAN runs of one level, one after another, become one run of
the next, so a row is written again once for each level and a read touches fewer
than FAN runs of each level, however many batches there were. All runs have the same
buckets: reading folds each bucket by itself and joins it with rows dealt out alike, so
stored features are never shuffled.

A run counts once its marker is there, which is made after the run is complete. The
name of a run says which batches it covers, and of runs that overlap the widest counts.
Writing a batch again replaces its own run, or does nothing if the run has been merged
already. A stream that begins with a new checkpoint needs a name of its own, as
its batches are numbered from 0 again.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.upsert import latest_per_key
from clickloom.schemas import FEATURE_KEY_COLUMNS, LANDED_DOCUMENT
from clickloom.sources.files import Folder

#: Buckets of a new table. A bucket is read by one task; large tables need thousands.
BUCKETS = 16
#: Runs of one level that become one of the next.
FAN = 4
STREAM = "main"

_RUN = re.compile(r"run-(\w+)-(-?\d+)-(\d+)")
_LAYOUT = re.compile(r"buckets-(\d+)")


@dataclass(frozen=True, order=True)
class Run:
    """The batches from `first` to before `end` of a stream."""

    stream: str
    first: int
    end: int

    @property
    def name(self) -> str:
        return f"run-{self.stream}-{self.first}-{self.end}"

    def covers(self, other: Run) -> bool:
        return self.stream == other.stream and self.first <= other.first and other.end <= self.end


def newest_per_key(events: DataFrame) -> DataFrame:
    """The last event of each key: by time, then by the event's id."""
    order = [c for c in ("event_timestamp", "event_id") if c in events.columns]
    return latest_per_key(events, FEATURE_KEY_COLUMNS, order)


class FeatureStore:
    """The table at `path`; `buckets` counts for a new one only."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, fan: int = FAN) -> None:
        self.spark, self.path, self.fan = spark, path.rstrip("/"), fan
        self.markers = Folder(spark, f"{self.path}/_store")
        layout = self._layout()
        if layout is None:
            self.markers.create(f"buckets-{buckets}")
            layout = self._layout()  # another writer may have been first
        self.buckets = layout

    def _layout(self) -> int | None:
        found = sorted(int(m[1]) for n in self.markers.names() if (m := _LAYOUT.fullmatch(n)))
        return found[0] if found else None

    def _table(self) -> str:
        """The catalog's name of the table, which this session knows after the call."""
        name = f"features_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LANDED_DOCUMENT.fields)
        keys = ", ".join(FEATURE_KEY_COLUMNS)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, run string) USING parquet "
            f"PARTITIONED BY (run) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        return name

    # -- writing

    def write(self, rows: DataFrame, batch_id: int, stream: str = STREAM) -> None:
        """The newest rows of a batch as a run, then the merges that are due."""
        run = Run(stream, batch_id, batch_id + 1)
        if not any(r.covers(run) and r != run for r in self._marked()):
            self._put(newest_per_key(rows), run)
        width = self.fan
        while (batch_id + 1) % width == 0:
            self.merge(Run(stream, batch_id + 1 - width, batch_id + 1))
            width *= self.fan

    def merge(self, wide: Run) -> None:
        """Makes one run of those that `wide` covers; batches without rows have none."""
        parts = [r for r in self.live() if wide.covers(r)]
        if parts and wide not in parts:
            self._put(newest_per_key(self._rows(parts)), wide)
            for part in parts:
                self.markers.delete(part.name)

    def replace(self, rows: DataFrame, stream: str = STREAM) -> None:
        """Rows of all batches so far as one run, which covers the first batch at
        least; later ones go on behind it."""
        self._put(newest_per_key(rows), Run(stream, -1, 0))

    def _put(self, rows: DataFrame, run: Run) -> None:
        table = self._table()
        missing = {f.name: F.lit(None) for f in LANDED_DOCUMENT.fields if f.name not in rows.columns}
        columns = [F.col(f.name).cast(f.dataType) for f in LANDED_DOCUMENT.fields]
        # one file for each bucket: rows are dealt out as buckets are
        dealt = rows.withColumns(missing).select(columns).repartition(self.buckets, *FEATURE_KEY_COLUMNS)
        # what an earlier attempt left goes first; a merge reads other runs of the table
        self.markers.delete(run.name)
        Folder(self.spark, self.path).delete(f"run={run.name}")
        dealt.withColumn("run", F.lit(run.name)).write.insertInto(table)
        self.markers.create(run.name)

    def vacuum(self) -> list[str]:
        """Deletes the folders of runs without a marker, such as merged ones, and says
        which. For times at which nothing reads or writes the table."""
        marked = {r.name for r in self._marked()}
        folders = Folder(self.spark, self.path)
        gone = [n for n in folders.names() if n.startswith("run=") and n.removeprefix("run=") not in marked]
        for name in gone:
            folders.delete(name)
        return gone

    # -- reading

    def _marked(self) -> list[Run]:
        found = (_RUN.fullmatch(n) for n in self.markers.names())
        return sorted(Run(m[1], int(m[2]), int(m[3])) for m in found if m)

    def live(self) -> list[Run]:
        """The runs that hold all rows: those that no other one covers."""
        marked = self._marked()
        return [r for r in marked if not any(o.covers(r) and o != r for o in marked)]

    def _rows(self, runs: list[Run]) -> DataFrame:
        name = self._table()
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        for run in runs:  # written by another session
            if f"run={run.name}" not in known:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (run = '{run.name}')")
        rows = self.spark.table(name)
        return rows.where(F.col("run").isin([r.name for r in runs])).drop("run")

    def read(self) -> DataFrame:
        """The newest row of each key, laid out by buckets."""
        return newest_per_key(self._rows(self.live()))

    def lookup(self, requests: DataFrame) -> DataFrame:
        """`requests` with the stored row of their key and `found`. Keys that many requests name
        are looked up once; stored rows stay where they are."""
        keys = FEATURE_KEY_COLUMNS
        stored = self.read().withColumn("found", F.lit(True))
        # dealt out as the buckets are; else Spark would deal both sides anew wherever
        # a session has more shuffle partitions than the table has buckets
        asked = requests.select(*keys).distinct().repartition(self.buckets, *keys)
        named = asked.join(stored, keys)
        return requests.join(named, keys, "left").withColumn("found", F.coalesce("found", F.lit(False)))
