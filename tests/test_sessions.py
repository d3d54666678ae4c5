import datetime
import random
from collections import Counter

import pytest

from clickloom.operators.sessions import sessionize, with_session_counts

BASE = datetime.datetime(2024, 1, 1)
SCHEMA = "event_id long, user_id long, event_timestamp timestamp_ntz"


def _by_hand(rows, gap):
    result, last, number = {}, {}, {}
    for event, user, ts in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        opens = user in last and ts > last[user] + datetime.timedelta(seconds=gap)
        number[user] = number.get(user, 0) + opens
        last[user] = ts
        result[event] = f"{user}-{number[user]}"
    return result


@pytest.mark.parametrize("gap", [60, 1800, 21600])
def test_against_brute_force(spark, gap):
    draw = random.Random(gap)
    rows = []
    for i in range(600):
        user = draw.choice([0, 0, 0, 1, 2, 3])
        step = draw.choice([0, gap // 2, gap, gap + 1, 3 * gap]) * draw.randint(0, 40)
        micros = draw.choice([0, 0, 1, 999_999])
        rows.append((i, user, BASE + datetime.timedelta(seconds=step, microseconds=micros)))
    df = spark.createDataFrame(rows, SCHEMA)
    expected = _by_hand(rows, gap)
    sizes = Counter(expected.values())
    for parts in (1, 5):
        found = sessionize(df.repartition(parts), gap_seconds=gap).collect()
        assert {r.event_id: r.user_session for r in found} == expected
        assert all(r.events_in_session == sizes[r.user_session] for r in found)


def test_a_gap_of_exactly_the_limit_does_not_break(spark):
    gap = 21600
    times = [0, gap, 2 * gap + 1]
    rows = [(i, 7, BASE + datetime.timedelta(seconds=s)) for i, s in enumerate(times)]
    rows.append((3, 7, BASE + datetime.timedelta(seconds=3 * gap + 1, microseconds=1)))
    found = sessionize(spark.createDataFrame(rows, SCHEMA)).orderBy("event_id").collect()
    assert [r.user_session for r in found] == ["7-0", "7-0", "7-1", "7-2"]


def test_rows_without_user_or_time_stay(spark):
    rows = [(1, None, BASE), (2, 5, None), (3, 5, BASE)]
    found = {r.event_id: r.user_session for r in
             sessionize(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: None, 2: None, 3: "5-0"}


def test_times_before_1970(spark):
    rows = [(i, 1, datetime.datetime(1969, 12, 31, h)) for i, h in enumerate((1, 6, 13))]
    found = sessionize(spark.createDataFrame(rows, SCHEMA)).orderBy("event_id").collect()
    assert [r.user_session for r in found] == ["1-0", "1-0", "1-1"]


def test_given_sessions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id long, user_session string")
    found = {r.id: r.events_in_session for r in with_session_counts(df).collect()}
    assert found == {1: 2, 2: 2, 3: 1, 4: None}
