"""The jobs one after another, from a CSV to scored requests."""

import json

from clickloom.__main__ import main
from clickloom.operators.measure import latest_load
from clickloom.plans import training


def _csv(path):
    lines = [
        "event_timestamp,user_id,product_id,user_session,price,brand,category_code_level1,"
        "category_code_level2,event_weekday,activity_count,is_purchased"
    ]
    for i in range(300):
        bought = int(i % 5 > 2)
        lines.append(
            f"2024-01-{1 + i % 28:02d} 10:00:00,{i},{i % 9},s{i},{10 + 100 * bought}.5,b{i % 4},"
            f"home,x.{i % 3},{i % 7},{1 + i % 4},{bought}"
        )
    path.write_text("\n".join(lines))


def test_from_csv_to_scores(spark, tmp_path):
    place = lambda name: str(tmp_path / name)
    _csv(tmp_path / "events.csv")
    main(["documents", place("events.csv"), place("source")])
    main(["land", place("source"), place("landed"), "--checkpoint", place("c1"), "--drain"])
    first = json.loads(spark.read.text(place("landed")).first().value)
    assert isinstance(first["user_id"], int) and isinstance(first["price"], float)
    main(["features", place("landed"), place("table"), "--checkpoint", place("c2"),
          "--quarantine", place("bad"), "--drain"])
    assert spark.read.parquet(place("bad")).count() == 0
    assert spark.read.parquet(place("table")).count() == 300

    spark.createDataFrame([], training.REGISTRY).write.parquet(place("registry"))
    main(["train", place("table"), place("models"), "--registry", place("registry"),
          "--run-id", "r1", "--rounds", "3"])
    requests = [
        {"request_id": "known", "user_id": 3, "product_id": 3, "user_session": "s3"},
        {"request_id": "known", "user_id": 4, "product_id": 4, "user_session": "s4"},
        {"request_id": "missing", "user_id": 3, "product_id": 8, "user_session": "s3"},
    ]
    (tmp_path / "requests.json").write_text("\n".join(map(json.dumps, requests)))
    main(["score", place("requests.json"), place("scores"), "--registry", place("registry"),
          "--features", place("table")])
    rows = spark.read.parquet(place("scores")).collect()
    assert sorted((r.request_id, r.success, r.prediction is not None) for r in rows) == [
        ("known", True, True), ("known", True, True), ("missing", False, False),
    ]


def test_star_schema_from_csv(spark, tmp_path):
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    rows = [
        "2024-01-01 23:59:59 UTC,view,1,7,a.b.c,acme,9.99,5,s1",
        "2024-01-02 00:00:01 UTC,cart,1,7,a.b.c,acme,19.99,5,s1",
        "2024-01-02 08:00:00 UTC,purchase,2,,d,,120,6,s2",
    ]
    (tmp_path / "raw.csv").write_text("\n".join([header, *rows]))
    main(["star", str(tmp_path / "raw.csv"), str(tmp_path / "star")])
    read = lambda name: spark.read.parquet(str(tmp_path / "star" / name))
    fact = read("fact_events").orderBy("event_timestamp").collect()
    assert [r.events_in_session for r in fact] == [2, 2, 1]
    assert [r.event_hour for r in fact] == [23, 0, 8]
    assert {(r.product_id, str(r.price), r.price_tier) for r in read("dim_product").collect()} == {
        (1, "19.99", "budget"), (2, "120.00", "standard"),
    }
    assert {r.category_l3 for r in read("dim_category").collect()} == {"c", None}
    assert read("dim_date").count() == 2 and read("dim_user").count() == 2


def test_equal_seconds_and_recoded_categories_keep_their_keys(spark, tmp_path):
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    rows = [
        "2024-01-01 10:00:00 UTC,view,1,7,old.code,acme,9.99,5,s1",
        "2024-01-01 10:00:00 UTC,view,1,7,new.code,acme,9.99,5,s2",
        "2024-01-02 10:00:00 UTC,view,1,7,new.code,acme,8.99,5,s2",
        "2024-01-02 10:00:00 UTC,view,1,7,new.code,acme,8.99,5,s2",
        "2024-01-02 11:00:00 UTC,view,2,8,,acme,8.99,5,s2",
    ]
    (tmp_path / "raw.csv").write_text("\n".join([header, *rows]))
    main(["star", str(tmp_path / "raw.csv"), str(tmp_path / "star")])
    fact = spark.read.parquet(str(tmp_path / "star" / "fact_events"))
    assert fact.count() == 4 and fact.select("event_key").distinct().count() == 4
    codes = {r.category_id: r.category_code for r in spark.read.parquet(str(tmp_path / "star" / "dim_category")).collect()}
    assert codes == {7: "new.code", 8: None}


def test_load_twice_and_check(spark, tmp_path):
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    rows = [
        "2024-01-01 10:00:00 UTC,view,1,7,a.b,acme,9.99,5,s1",
        "2024-01-01 10:00:00 UTC,view,1,7,a.b,acme,9.99,5,s1",
        "2024-01-02 10:00:00 UTC,cart,,7,a.b,acme,,5,s2",
    ]
    (tmp_path / "raw.csv").write_text("\n".join([header, *rows]))
    raw, star, out = (str(tmp_path / n) for n in ("raw.csv", "star", "checks"))
    log = str(tmp_path / "log")
    loads = []
    for _ in range(2):
        main(["load", raw, "records_test", "--location", str(tmp_path / "records"), "--log", log])
        loads.append({r.metric: r.value for r in latest_load(spark, log).collect()})
    assert spark.table("records_test").count() == 2
    counts = ["total_records", "valid_records", "invalid_records", "duplicate_records"]
    assert [[load[c] for c in counts] for load in loads] == [[3, 2, 1, 1], [3, 2, 1, 3]]
    assert all(load["processing_time"] > 0 for load in loads)
    main(["star", raw, star])
    main(["check", star, out, "--records", "records_test", "--log", log])
    read = lambda name: spark.read.parquet(f"{out}/{name}").collect()
    assert [(r.observed, r.success) for r in read("row_counts")] == [(2, True)]
    assert {r.fk_name: r.violations for r in read("foreign_keys")} == dict.fromkeys(
        ("user_id", "product_id", "category_id", "event_date"), 0
    )
    assert {r.metric: r.value for r in read("metrics")}["invalid_records"] == 1
    assert {r.rule: r.fired for r in read("alerts")}["low_volume"]
    assert {r.rule: r.fired for r in read("load_alerts")} == {
        "more_invalid_than_valid": False, "many_duplicates": False, "low_volume": True,
        "high_volume": False, "long_processing": False,
    }
    spark.sql("DROP TABLE records_test")
