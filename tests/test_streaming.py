import datetime
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickloom.operators.sessions import sessionize
from clickloom.sources.notifications import notified_paths
from clickloom.streaming import features as stream
from clickloom.streaming.landing import copy_to_landing, landed_events
from clickloom.streaming.rates import count_stream, read_rates, request_rate, stream_request_rate
from clickloom.streaming.sessions import stream_sessions


def _event(user=1, product=1, session="s", time="2024-01-01 00:00:00", price=1.0, **more):
    return {
        "event_timestamp": time, "user_id": user, "product_id": product, "user_session": session,
        "price": price, "brand": "b", "category_code_level1": "x", "category_code_level2": None,
        "event_weekday": 0, "activity_count": 1, "is_purchased": 0, **more,
    }


def _land(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    lines = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    (folder / f"{name}.json").write_text("\n".join(lines))


@pytest.fixture
def places(tmp_path):
    return {n: tmp_path / n for n in ("landed", "table", "checkpoint", "bad")}


def _run(spark, places, publish=None, max_files=1):
    query = stream.stream_features(
        landed_events(spark, str(places["landed"]), max_files=max_files),
        str(places["table"]), str(places["checkpoint"]), str(places["bad"]), publish, drain=True,
    )
    query.awaitTermination()


def _prices(spark, places):
    rows = stream.read_features(spark, str(places["table"])).collect()
    return {(r.user_id, r.product_id, r.user_session): r.price for r in rows}


def test_latest_wins_across_batches_even_when_older_comes_later(spark, places):
    _land(places["landed"], "1", _event(price=5.0, time="2024-01-02 00:00:00"))
    _run(spark, places)
    _land(places["landed"], "2", _event(price=1.0, time="2024-01-01 00:00:00"), _event(user=2))
    _run(spark, places)
    assert _prices(spark, places) == {(1, 1, "s"): 5.0, (2, 1, "s"): 1.0}
    _land(places["landed"], "3", _event(price=7.0, time="2024-01-03 00:00:00"))
    _run(spark, places)
    assert _prices(spark, places)[(1, 1, "s")] == 7.0


def test_malformed_and_keyless_rows_are_set_aside(spark, places):
    _land(
        places["landed"], "1", _event(), '{"user_id": "x", "price": 1', _event(user=None),
        _event(user=3, price="NaN"), _event(user=4, event_weekday=2.0),
    )
    _run(spark, places)
    kept = _prices(spark, places)
    bad = spark.read.parquet(str(places["bad"])).count()
    assert (1, 1, "s") in kept and (None, 1, "s") not in kept
    assert len(kept) + bad == 5 and bad >= 2


def test_replaying_a_batch_changes_nothing(spark, places):
    frame = spark.createDataFrame([(1,)], "x int").select(
        F.lit(None).cast("string").alias("_corrupt_record"),
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("event_timestamp"),
        F.lit(1).cast("long").alias("user_id"), F.lit(2).cast("long").alias("product_id"),
        F.lit("s").alias("user_session"), F.lit(3.0).alias("price"), F.lit("b").alias("brand"),
        F.lit("x").alias("category_code_level1"), F.lit("y").alias("category_code_level2"),
        F.lit(1).cast("long").alias("event_weekday"),
        F.lit(1).cast("long").alias("activity_count"), F.lit(0).cast("long").alias("is_purchased"),
    )
    write = stream.feature_batch_writer(str(places["table"]))
    write(frame, 0)
    first = stream.read_features(spark, str(places["table"])).collect()
    write(frame, 0)
    assert spark.read.parquet(str(places["table"])).count() == 1
    assert stream.read_features(spark, str(places["table"])).collect() == first


def test_a_failing_sink_loses_nothing(spark, places):
    for i in range(4):
        _land(places["landed"], str(i), _event(user=i))
    delivered = []

    def publish(rows, batch_id):
        if batch_id == 1 and not publish.healed:
            raise RuntimeError("store is away")
        delivered.extend(r.feature_key for r in rows.collect())

    publish.healed = False
    with pytest.raises(StreamingQueryException):
        _run(spark, places, publish)
    assert len(delivered) == 1
    publish.healed = True
    _run(spark, places, publish)
    assert sorted(delivered) == [f"user:{i}:product:1:session:s" for i in range(4)]
    assert len(_prices(spark, places)) == 4


def test_compaction_keeps_the_result(spark, places, tmp_path):
    for i in range(3):
        _land(places["landed"], str(i), _event(price=float(i), time=f"2024-01-0{i + 1} 00:00:00"))
    _run(spark, places)
    target = str(tmp_path / "compact")
    stream.compact_features(spark, str(places["table"]), target)
    assert spark.read.parquet(target).count() == 1
    assert stream.read_features(spark, target).first().price == 2.0


def test_notifications(spark):
    messages = [b'{"Key": "b/1.json"}', b"oops", b'{"Other": 1}', b'{"Key": ""}', None,
                b'{"Key": "b/1.json"}', b'{"Key": null}']
    df = spark.createDataFrame([(m,) for m in messages], "value binary")
    paths = [r.s3_path for r in notified_paths(df).collect()]
    assert paths == ["s3a://b/1.json", "s3a://b/1.json"]


def test_stream_of_notifications_loads_the_named_objects(spark, places, tmp_path):
    for i in range(3):
        _land(places["landed"], str(i), _event(user=i))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    named = [json.dumps({"Key": str(places["landed"] / f"{i}.json")}) for i in (0, 2, 2, 7)]
    (inbox / "a.txt").write_text("\n".join([*named, "oops"]))
    write, absent = stream.feature_batch_writer(str(places["table"])), str(tmp_path / "absent")
    (
        spark.readStream.text(str(inbox))
        .select(F.encode("value", "UTF-8").alias("value"))
        .writeStream.foreachBatch(stream.notified_batch_writer(write, absent, scheme="file://"))
        .option("checkpointLocation", str(places["checkpoint"]))
        .trigger(availableNow=True).start().awaitTermination()
    )
    assert {k[0] for k in _prices(spark, places)} == {0, 2}
    # the object that is gone is named, and does not hold up the others
    assert [r.s3_path for r in spark.read.parquet(absent).collect()] == [f"file://{places['landed']}/7.json"]


def test_bad_rows_are_kept_without_being_asked_to(spark, places):
    _land(places["landed"], "a", _event())
    (places["landed"] / "b.json").write_text('{"user_id": 1, broken')
    (places["landed"] / "c.json").write_text('{"product_id": 5}')
    stream.stream_features(
        landed_events(spark, str(places["landed"])), str(places["table"]), str(places["checkpoint"]), drain=True
    ).awaitTermination()
    aside = stream.read_quarantine(spark, stream.quarantine_of(str(places["table"]))).collect()
    assert sorted((r.product_id, r._corrupt_record) for r in aside if r.product_id) == [(5, None)]
    assert [r._corrupt_record for r in aside if r._corrupt_record] == ['{"user_id": 1, broken']
    assert len(_prices(spark, places)) == 1


def test_events_of_one_second_are_settled_by_their_id(spark, places):
    for name, event_id, price in (("a", 8, 1.0), ("b", 7, 99.0)):
        _land(places["landed"], name, _event(price=price) | {"event_id": event_id})
    _run(spark, places)
    assert list(_prices(spark, places).values()) == [1.0]


def test_rows_later_than_the_watermark_are_not_counted(spark, tmp_path):
    from clickloom.streaming import rates

    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    base = datetime.datetime(2024, 1, 1)

    def batch(*minutes):
        rows = [(base + datetime.timedelta(minutes=m), "view") for m in minutes]
        spark.createDataFrame(rows, "ts timestamp, kind string").write.mode("append").parquet(folder)
        source = spark.readStream.schema("ts timestamp, kind string").parquet(folder)
        rates.count_stream(source, "ts", "kind", "10 minutes", out, check).awaitTermination()

    batch(0, 60)
    batch(61)
    batch(0, 55)  # the first is an hour late, the second within the ten minutes
    found = {r.window_start: round(r.rate * 300) for r in rates.read_rates(spark, out, "kind").collect()}
    assert found[base] == 1
    assert found[base + datetime.timedelta(minutes=55)] == 1


def _times(spark, seconds, user=1):
    base = datetime.datetime(2024, 1, 1)
    rows = [(i, user, base + datetime.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "event_id long, user_id long, event_timestamp timestamp_ntz")


def _as_stream(spark, df, folder):
    df.repartition(2).write.parquet(str(folder))
    zoned = F.col("event_timestamp").cast("timestamp")
    return (
        spark.readStream.schema(df.schema).parquet(str(folder))
        .withColumn("event_timestamp", zoned)
    )


def _append(spark, df, tmp_path, name):
    out, check = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-check")
    (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(out)


def test_streamed_sessions_agree_with_the_table(spark, tmp_path):
    hour = 3600
    far = 400 * hour  # pushes the watermark past every session under test
    df = _times(spark, [0, hour, 7 * hour, 14 * hour, 20 * hour, 40 * hour, far])
    batch = {
        (r.session_start, r.n)
        for r in sessionize(df).groupBy("user_session")
        .agg(F.min("event_timestamp").alias("session_start"), F.count("*").alias("n")).collect()
        if r.session_start < datetime.datetime(2024, 1, 10)
    }
    streamed = _append(
        spark, stream_sessions(_as_stream(spark, df, tmp_path / "in"), "1 hour"), tmp_path, "s"
    )
    rows = streamed.withColumn("session_start", F.col("session_start").cast("timestamp_ntz"))
    assert {(r.session_start, r.event_count) for r in rows.collect()} == batch


def test_streamed_rate_agrees_with_the_table(spark, tmp_path):
    df = _times(spark, [0, 30, 59, 60, 200, 299, 300, 86400]).withColumn("kind", F.lit("view"))
    end = datetime.datetime(2024, 1, 1, 12)
    batch = {
        (r.window_start, r.rate)
        for r in request_rate(df, "event_timestamp", "kind").collect() if r.window_start < end
    }
    streaming = stream_request_rate(
        _as_stream(spark, df, tmp_path / "in"), "event_timestamp", "kind", "10 minutes"
    )
    rows = _append(spark, streaming, tmp_path, "r")
    rows = rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()
    assert {(r.window_start, r.rate) for r in rows} == batch
    assert max(r.rate for r in rows) == 6 / 300


def test_documents_are_landed_once(spark, tmp_path):
    source, landing = tmp_path / "source", str(tmp_path / "landing")
    places = (str(source), landing, str(tmp_path / "check"))

    def copied():
        copy_to_landing(spark, *places, drain=True).awaitTermination()
        return sorted(json.loads(r.value)["user_id"] for r in spark.read.text(landing).collect())

    _land(source, "1", _event(user=1))
    _land(source, "2", _event(user=2))
    assert copied() == [1, 2]
    assert copied() == [1, 2]
    _land(source, "3", _event(user=3))
    assert copied() == [1, 2, 3]


def test_kept_rates_follow_the_last_batch(spark, tmp_path):
    df = _times(spark, [0, 30, 90]).withColumn("kind", F.lit("view"))
    folder, path, check = tmp_path / "in", str(tmp_path / "rates"), str(tmp_path / "check")
    df.limit(2).coalesce(1).write.parquet(str(folder))
    source = spark.readStream.schema(df.schema).parquet(str(folder)).withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp")
    )
    for _ in range(2):
        count_stream(source, "event_timestamp", "kind", "1 hour", path, check).awaitTermination()
        df.where("event_id = 2").coalesce(1).write.mode("append").parquet(str(folder))
    found = read_rates(spark, path, "kind")
    found = found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    expected = request_rate(df, "event_timestamp", "kind")
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
