import datetime
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from clickloom.operators.ordered import number_rows
from clickloom.plans import warehouse
from clickloom.schemas import FACT_EVENTS, LANDED_EVENT, RAW_EVENT
from clickloom.session import object_store_options, scratch_path
from clickloom.sources import files, tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_round_trip(spark, tmp_path):
    stamp = datetime.datetime(2024, 1, 1, 1, 2, 3, 456789)
    rows = spark.createDataFrame([(stamp, 1, "é"), (stamp, 2, None)], "event_timestamp timestamp, user_id long, brand string")
    files.write_documents(rows, str(tmp_path / "out"), rows_per_file=1)
    texts = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(json.loads(t)["event_timestamp"] for t in texts) == ["2024-01-01 01:02:03"] * 2
    back = files.scan_json(spark, str(tmp_path / "out")).orderBy("user_id").collect()
    assert [(r.user_id, r.brand, r.price) for r in back] == [(1, "é", None), (2, None, None)]


def test_json_fields_that_do_not_fit_read_as_null(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"user_id": "many", "price": 2.5}\n{"user_id": 2.0, "price": "NaN"}\nnot json\n')
    found = files.scan_json(spark, str(path), keep_corrupt=True).cache()
    assert found.count() == 3
    assert [r.user_id for r in found.collect()] == [None, None, None]
    assert found.where(F.col(files.CORRUPT) == "not json").count() == 1
    assert found.schema.fieldNames()[:-1] == LANDED_EVENT.fieldNames()


def test_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('event_time,brand,price\n2024-01-01 00:00:00 UTC,"a,b",1.5\n,,\n')
    schema = "event_time string, brand string, price double"
    rows = files.scan_csv(spark, str(path), schema).collect()
    assert [tuple(r) for r in rows] == [("2024-01-01 00:00:00 UTC", "a,b", 1.5), (None, None, None)]


def test_partition_pruning(spark, tmp_path):
    days = [datetime.datetime(2024, 12, 31), datetime.datetime(2025, 1, 5), datetime.datetime(2025, 2, 1)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "event_id long, event_timestamp timestamp_ntz")
    files.write_by_day(df, str(tmp_path / "events"))
    january = files.PartitionedSource(str(tmp_path / "events"), {"year": 2025, "month": 1, "day": 5}).scan(spark)
    assert [r.event_id for r in january.collect()] == [1]
    plan = _plan(january)
    assert "PartitionFilters: [isnotnull(year" in plan


def test_a_feed_is_not_read_whole_by_mistake(spark, tmp_path):
    spark.range(3).selectExpr("id", "id AS day").write.partitionBy("day").parquet(str(tmp_path / "x"))
    for prefix in ({}, {"hour": 1}):
        with pytest.raises(ValueError):
            files.PartitionedSource(str(tmp_path / "x"), prefix).scan(spark)


def test_create_and_insert(spark, tmp_path):
    name = "fact_events_test"
    for _ in range(2):
        tables.create_table(spark, name, FACT_EVENTS, ["event_date"], str(tmp_path / "fact"))
    events = spark.createDataFrame(
        [(i, "view", 1, 2, 3, datetime.datetime(2024, 1, 1 + i % 3, 5), "s") for i in range(9)],
        "event_id long, event_type string, user_id long, product_id long, category_id long, "
        "event_timestamp timestamp_ntz, user_session string",
    )
    fact = warehouse.fact_events(events)
    for _ in range(2):
        tables.insert_new(spark, name, fact, ["event_key"], ["event_timestamp"], ["event_date"])
    stored = spark.table(name)
    assert stored.count() == 9
    assert stored.where("event_date = DATE'2024-01-02'").count() == 3
    assert {(r.event_hour, r.events_in_session) for r in stored.collect()} == {(5, 9)}
    assert sorted(p.name for p in (tmp_path / "fact").glob("event_date=*")) == [
        f"event_date=2024-01-0{d}" for d in (1, 2, 3)
    ]
    spark.sql(f"DROP TABLE {name}")


def test_cart_predicate_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = _plan(warehouse.cart_purchase_events(events, ("cart", "purchase")))
    assert "PushedFilters: [In(event_type, [cart,purchase])]" in plan


def test_no_keys_among_the_store_options():
    options = object_store_options("store:9000", ssl=False)
    assert options["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert not [k for k in options if "key" in k or "secret" in k]


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_only_touched_partitions_are_read(spark, tmp_path):
    days = spark.range(40).select(
        F.col("id").alias("event_key"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 20).cast("int")).alias("event_date"),
    )
    days.write.partitionBy("event_date").parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    incoming = days.where("event_date = DATE'2024-01-03'")
    held = tables.touched_partitions(stored, incoming, ["event_date"])
    assert {r.event_key for r in held.collect()} == {2, 22}
    assert "DataFilters: []" in _plan(held) and "= 2024-01-03)" in _plan(held)


def test_raw_records(spark):
    row = ("2024-01-01", "view", 1, 2, "a.b", None, 3.0, 4, "s")
    schema = (
        "event_time string, event_type string, product_id long, category_id long, "
        "category_code string, brand string, price double, user_id long, user_session string"
    )
    rows = [row, row, (*row[:6], None, *row[7:])]
    found = warehouse.raw_records(spark.createDataFrame(rows, schema), "import")
    assert found.columns == RAW_EVENT.fieldNames()
    found = found.collect()
    assert sorted(r.valid for r in found) == ["false", "true", "true"]
    assert len({r.record_hash for r in found}) == 2
    assert all(r.processed_date and r.processing_pipeline == "import" for r in found)


def test_rows_are_numbered_from_one(spark):
    df = spark.range(0, 500, 1, 9).select((F.col("id") * 3).alias("k"))
    found = {r.k: r.row_id for r in number_rows(df, ["k"]).collect()}
    assert found == {3 * i: i + 1 for i in range(500)}


def test_documents_keep_the_row_number_beside_them(spark):
    df = spark.createDataFrame(
        [(1, datetime.datetime(2024, 1, 1), "x")], "row_id long, event_timestamp timestamp, brand string"
    )
    [row] = files.to_documents(df, keep=["row_id"]).collect()
    assert row.row_id == 1 and json.loads(row.value).keys() == {"event_timestamp", "brand"}


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_a_cluster_must_name_a_shared_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session, "x")
