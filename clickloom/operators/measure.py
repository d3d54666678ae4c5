"""A load measured while it runs: its counts come from the rows that pass, its time from
the clock around the write, so no table is scanned again."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRICS = "metric string, value double"

_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_CUTS_EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


class LoadMeasure:
    """`incoming` and `written` mark the rows before and after what is known is left
    out; the block is the load:

        measure = LoadMeasure(spark, valid)
        with measure:
            write(measure.written(leave_out(measure.incoming(rows))))

    A row that is incoming and not written is a duplicate, of another one or of a row
    that the table holds. Observed counts take part in no result; should Spark run a lost
    stage again, they may count its rows again.
    """

    def __init__(self, spark: SparkSession, valid: Column) -> None:
        self._spark = spark
        self._valid = F.coalesce(valid.cast("boolean"), F.lit(False))
        self._seen, self._kept = Observation(), Observation()
        self.seconds: float | None = None

    def incoming(self, rows: DataFrame) -> DataFrame:
        return rows.observe(
            self._seen, F.count(F.lit(1)).alias("total"), F.count_if(self._valid).alias("valid")
        )

    def written(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._kept, F.count(F.lit(1)).alias("written"))

    def __enter__(self) -> LoadMeasure:
        # where nothing is new, AQE would cut off the plan and the counts with it
        self._excluded = self._spark.conf.get(_EXCLUDED, None)
        self._spark.conf.set(_EXCLUDED, ",".join(filter(None, (self._excluded, _CUTS_EMPTY))))
        self._began = time.monotonic()
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:  # a load that broke off has no time
            self.seconds = time.monotonic() - self._began
        if self._excluded is None:
            self._spark.conf.unset(_EXCLUDED)
        else:
            self._spark.conf.set(_EXCLUDED, self._excluded)

    def metrics(self) -> DataFrame:
        """(metric, value) of the finished load, as the alerts read them."""
        if self.seconds is None:
            raise ValueError("nothing has been loaded")
        seen, kept = self._seen.get, self._kept.get
        values = {
            "total_records": seen["total"],
            "valid_records": seen["valid"],
            "invalid_records": seen["total"] - seen["valid"],
            "duplicate_records": seen["total"] - kept["written"],
            "processing_time": self.seconds,
        }
        return self._spark.createDataFrame([(k, float(v)) for k, v in values.items()], METRICS)


def append_to_log(metrics: DataFrame, path: str) -> None:
    """Adds a load's metrics, with the time of logging, to the log at `path`."""
    metrics.withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def latest_load(spark: SparkSession, path: str) -> DataFrame:
    """(metric, value) of the load logged last."""
    log = spark.read.schema(f"{METRICS}, loaded_at timestamp").parquet(path)
    newest = log.groupBy("metric").agg(F.max(F.struct("loaded_at", "value")).alias("newest"))
    return newest.select("metric", F.col("newest.value").alias("value"))
