"""Distinct events and sessions on a stream: what passes, and what state is held."""

import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.streaming.distinct import write_distinct
from clickloom.streaming.sessions import closing_event, write_sessions

START = datetime.datetime(2024, 1, 1)
EVENT = "event_timestamp timestamp, user_id long, event_type string"


def _send(spark, feed, *rows):
    """A file of events: (minute, user, type)."""
    events = [(START + datetime.timedelta(minutes=m), u, t) for m, u, t in rows]
    spark.createDataFrame(events, EVENT).coalesce(1).write.mode("append").parquet(feed)


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / n) for n in ("feed", "out", "cursor")]


def _distinct(spark, feed, out, cursor, lateness="10 minutes"):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(feed)
    query = write_distinct(stream, out, cursor, lateness, ["event_timestamp", "user_id", "event_type"], drain=True)
    query.awaitTermination()
    return query


def _minutes(spark, out):
    rows = spark.read.schema(EVENT).parquet(out).collect()
    return sorted((int((r.event_timestamp - START).total_seconds() // 60), r.user_id, r.event_type) for r in rows)


def test_events_sent_again_pass_once(spark, places):
    feed, out, cursor = places
    _send(spark, feed, (0, 1, "view"), (0, 1, "view"), (1, 2, None), (1, None, "view"))
    _distinct(spark, feed, out, cursor)
    _send(spark, feed, (0, 1, "view"), (1, 2, None), (1, None, "view"), (0, 1, "cart"))
    _distinct(spark, feed, out, cursor)  # the state outlives the query
    rows = spark.read.schema(EVENT).parquet(out).collect()
    assert sorted((r.user_id or 0, r.event_type or "") for r in rows) == [
        (0, "view"), (1, "cart"), (1, "view"), (2, ""),
    ]


def test_state_stays_bounded(spark, places):
    """A feed of an hour's events, a minute a file: ten minutes of them are held."""
    feed, out, cursor = places
    held = []
    for minute in range(0, 60, 5):
        _send(spark, feed, *[(minute + k, u, "view") for k in range(5) for u in range(20)] * 2)
        query = _distinct(spark, feed, out, cursor)
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
    assert len(_minutes(spark, out)) == 60 * 20
    assert max(held) <= 20 * 20 < 60 * 20 and held[-1] <= max(held[:4])


def _sessions(spark, feed, out, cursor, gap=600):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(feed)
    write_sessions(stream, out, cursor, "10 minutes", gap_seconds=gap, drain=True).awaitTermination()
    schema = "user_id long, event_count long, session_start timestamp, session_end timestamp"
    rows = spark.read.schema(schema).parquet(out).collect()
    minute = lambda t: int((t - START).total_seconds() // 60)
    return sorted((r.user_id, minute(r.session_start), minute(r.session_end), r.event_count) for r in rows)


def test_sessions_are_written_once_closed(spark, places):
    feed, out, cursor = places
    _send(spark, feed, (0, 1, "view"), (10, 1, "view"), (21, 1, "view"), (3, 2, "view"), (4, None, "view"))
    assert _sessions(spark, feed, out, cursor) == []
    _send(spark, feed, (12, 2, "view"), (60, 3, "view"))
    # 1's events at 0 and 10 are exactly a gap apart; the watermark has passed all but user 3
    assert _sessions(spark, feed, out, cursor) == [(1, 0, 10, 2), (1, 21, 21, 1), (2, 3, 12, 2)]
    sent = spark.read.schema(EVENT).parquet(feed)
    last = closing_event(spark, sent, "10 minutes", gap_seconds=600)
    assert last.count() == 1 and last.first().user_id is None
    last.write.mode("append").parquet(feed)
    assert _sessions(spark, feed, out, cursor) == [(1, 0, 10, 2), (1, 21, 21, 1), (2, 3, 12, 2), (3, 60, 60, 1)]


def test_state_of_sessions_goes_with_them(spark, places):
    feed, out, cursor = places
    for hour in range(4):
        _send(spark, feed, *[(60 * hour + k, u, "view") for k in range(5) for u in range(10)])
        _sessions(spark, feed, out, cursor)
    assert len(_sessions(spark, feed, out, cursor)) == 30
    assert spark.read.schema(EVENT).parquet(feed).where(F.col("user_id") == 1).count() == 20
