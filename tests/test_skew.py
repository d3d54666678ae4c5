"""A key holding a third of the rows must be split, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators.lookup import feature_lookup
from clickloom.operators.sessions import sessionize, with_session_counts
from clickloom.plans.features import event_features, latest_features

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Session 'hot' of user 0 holds a third of the rows, all for product 0."""
    path = str(tmp_path_factory.mktemp("skew") / "events")
    hot = F.col("event_id") % 3 == 0
    noise = F.sha2(F.col("event_id").cast("string"), 512)
    (
        spark.range(0, 60_000, 1, 16).withColumnRenamed("id", "event_id")
        .select(
            "event_id",
            F.when(hot, 0).otherwise(F.col("event_id") % 5000 + 1).cast("long").alias("user_id"),
            F.when(hot, 0).otherwise(F.col("event_id") % 700).cast("long").alias("product_id"),
            F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("event_id") % 5000))
            .alias("user_session"),
            F.when(F.col("event_id") % 4 == 0, "purchase").otherwise("view").alias("event_type"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") % 3000)
            .cast("timestamp_ntz").alias("event_timestamp"),
            F.lit(1.0).alias("price"), noise.alias("brand"), F.lit("a.b").alias("category_code"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def _final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_session_join_is_split(small_partitions, events):
    rows, plan = _final_plan(sessionize(events.drop("user_session")))
    assert "skew=true" in plan
    assert len(rows) == 60_000
    assert max(r.events_in_session for r in rows) == 20_000


def test_count_join_is_split(small_partitions, events):
    rows, plan = _final_plan(with_session_counts(events))
    assert "skew=true" in plan
    assert sum(r.user_session == "hot" and r.events_in_session == 20_000 for r in rows) == 20_000


def test_label_join_is_split(small_partitions, events):
    counted = events.withColumn("events_in_session", F.lit(1))
    rows, plan = _final_plan(event_features(counted))
    assert "skew=true" in plan
    assert len(rows) == 60_000 and all(r.is_purchased == 1 for r in rows if r.user_id == 0)


def test_a_hot_key_has_one_latest_row(small_partitions, events):
    rows = latest_features(events.withColumn("events_in_session", F.lit(1))).collect()
    assert sum(r.user_id == 0 for r in rows) == 1


def test_lookup_of_a_hot_key_is_split(small_partitions, events):
    keys = ["user_id", "product_id", "user_session"]
    requests = events.select(F.col("brand").alias("request_id"), *keys)
    known = events.where("user_id != 1").groupBy(*keys).agg(F.max("price").alias("price"))
    rows, plan = _final_plan(feature_lookup(requests, known))
    assert "skew=true" in plan
    missing = events.where("user_id = 1").count()
    assert len(rows) == 60_000 and sum(not r.batch_ok for r in rows) == missing > 0


def test_a_scanned_frame_keeps_its_partitions(spark, tmp_path):
    from clickloom.operators.skew import shuffled_apart

    spark.range(4000).repartition(40).write.parquet(str(tmp_path / "wide"))
    scanned = spark.read.parquet(str(tmp_path / "wide"))
    assert shuffled_apart(scanned).rdd.getNumPartitions() == scanned.rdd.getNumPartitions()
    counted = scanned.groupBy("id").count()
    assert "Coalesce" in shuffled_apart(counted)._jdf.queryExecution().toString()
