import pytest
from pyspark.sql import functions as F

from clickloom.operators import quality
from clickloom.operators.upsert import insert_ignore, latest_per_key
from clickloom.schemas import GOLD_ROW_BOUNDS, RAW_ROW_BOUNDS


def test_row_count_bounds(spark):
    empty, one = spark.range(0), spark.range(1)
    assert quality.row_count_check(empty, "raw", RAW_ROW_BOUNDS).first().success
    assert not quality.row_count_check(empty, "gold", GOLD_ROW_BOUNDS).first().success
    assert quality.row_count_check(one, "gold", GOLD_ROW_BOUNDS).first().success
    assert not quality.row_count_check(spark.range(1_000_001), "gold", GOLD_ROW_BOUNDS).first().success


def _alerts(spark, **metrics):
    df = spark.createDataFrame(list(metrics.items()), "metric string, value long")
    return {r.rule: r.fired for r in quality.load_alerts(df).collect()}


def test_alert_thresholds(spark):
    fired = _alerts(
        spark, total_records=99, valid_records=1, invalid_records=2, duplicate_records=101,
        processing_time=3601,
    )
    assert fired == {
        "more_invalid_than_valid": True, "many_duplicates": True, "low_volume": True,
        "high_volume": False, "long_processing": True,
    }
    quiet = _alerts(
        spark, total_records=1_000_000, valid_records=2, invalid_records=2, duplicate_records=100,
        processing_time=3600,
    )
    assert not any(quiet.values())


def test_a_missing_metric_is_not_evaluated(spark):
    fired = _alerts(spark, duplicate_records=0)
    assert fired["low_volume"] is None and fired["many_duplicates"] is False


def test_load_metrics(spark):
    rows = [(True, "aa" * 32), (True, "aa" * 32), (False, "bb" * 32)]
    df = spark.createDataFrame(rows, "valid boolean, record_hash string")
    found = {r.metric: r.value for r in quality.load_metrics(df).collect()}
    assert found == {
        "total_records": 3, "valid_records": 2, "invalid_records": 1, "duplicate_records": 1,
    }


def test_planted_fk_violations(spark):
    fact = spark.createDataFrame(
        [(1, 10), (1, 11), (2, None), (None, 10), (9, 99), (9, 99)], "user_id long, product_id long"
    )
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    products = spark.createDataFrame([(10,)], "product_id long")
    found = quality.fk_violations(fact, {"user_id": users, "product_id": products}).collect()
    assert {r.fk_name: r.violations for r in found} == {"user_id": 2, "product_id": 3}


def test_latest_per_key_does_not_depend_on_order(spark):
    rows = [("k", 1, "old"), ("k", 3, "b"), ("k", 3, "a"), ("j", None, "only"), ("i", None, "x"), ("i", 0, "y")]
    df = spark.createDataFrame(rows, "key string, t int, v string")
    for parts in (1, 4):
        found = latest_per_key(df.repartition(parts), ["key"], ["t"]).collect()
        assert {(r.key, r.t, r.v) for r in found} == {("k", 3, "b"), ("j", None, "only"), ("i", 0, "y")}


def test_insert_ignore(spark):
    stored = spark.createDataFrame([(1, 5.0)], "id long, v double")
    incoming = spark.createDataFrame(
        [(1, 9.0, 1), (2, float("nan"), 1), (2, 7.0, 2), (3, 1.0, 2), (3, 2.0, 1)],
        "id long, v double, n int",
    )
    found = insert_ignore(stored, incoming, ["id"], ["n"]).collect()
    assert {(r.id, r.v) for r in found} == {(1, 5.0), (2, None), (3, 2.0)}


def test_a_load_is_measured_as_it_runs(spark, tmp_path, monkeypatch):
    from clickloom.operators import measure as M

    jobs = spark.sparkContext.statusTracker()
    rows = spark.createDataFrame(
        [(1, True), (1, True), (2, False), (3, None), (None, True)], "key int, valid boolean"
    )
    spark.sparkContext.setJobGroup("measured", "load")
    load = M.LoadMeasure(spark, F.col("valid"))
    clock = iter([100.0, 100.0 + 3601])
    monkeypatch.setattr(M.time, "monotonic", lambda: next(clock))
    with load:
        load.written(load.incoming(rows).dropDuplicates(["key"])).write.parquet(str(tmp_path / "t"))
    before = len(jobs.getJobIdsForGroup("measured"))
    found = {r.metric: r.value for r in load.metrics().collect()}
    assert found == {
        "total_records": 5, "valid_records": 3, "invalid_records": 2, "duplicate_records": 1,
        "processing_time": 3601,
    }
    assert before >= 1
    fired = {r.rule: r.fired for r in quality.load_alerts(load.metrics()).collect()}
    assert fired["long_processing"] and fired["low_volume"] and not fired["more_invalid_than_valid"]


def test_a_load_that_breaks_off_has_no_metrics(spark):
    from clickloom.operators.measure import LoadMeasure

    load = LoadMeasure(spark, F.lit(True))
    with pytest.raises(RuntimeError):
        with load:
            raise RuntimeError("disk is full")
    with pytest.raises(ValueError):
        load.metrics()


def test_a_load_of_nothing_new_is_measured_too(spark, tmp_path):
    from clickloom.operators.measure import LoadMeasure
    from clickloom.operators.upsert import new_rows

    rows = spark.createDataFrame([(i, 1, True) for i in range(50)], "key int, sent int, valid boolean")
    rows.write.parquet(str(tmp_path / "held"))
    held = spark.read.parquet(str(tmp_path / "held"))
    for n, (incoming, total) in enumerate([(held, 50), (rows.limit(0), 0)]):
        load = LoadMeasure(spark, F.col("valid"))
        with load:
            added = new_rows(held, load.incoming(incoming), ["key"], ["sent"])
            load.written(added).write.parquet(str(tmp_path / f"out{n}"))
        found = {r.metric: r.value for r in load.metrics().collect()}
        assert (found["total_records"], found["duplicate_records"]) == (total, total)
    assert spark.conf.get("spark.sql.adaptive.optimizer.excludedRules", None) is None
