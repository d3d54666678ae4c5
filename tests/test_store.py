"""The keyed store: runs, merges, replays, and lookups that leave it where it is."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators.lookup import answered, feature_lookup
from clickloom.schemas import FEATURE_KEY_COLUMNS
from clickloom.sources.files import Folder
from clickloom.streaming.store import FeatureStore, Run, newest_per_key


def _rows(spark, *keys, price=1.0, minute=0):
    stamp = datetime.datetime(2024, 1, 1, 0, minute)
    rows = [(stamp, k, k % 7, f"s{k % 3}", price, k) for k in keys]
    return spark.createDataFrame(
        rows,
        "event_timestamp timestamp, user_id long, product_id long, user_session string, price double, event_id long",
    )


def _prices(store):
    return {r.user_id: r.price for r in store.read().collect()}


def _fill(spark, store, batches, first=0):
    """Batch n renews half of the keys and adds one of its own."""
    for n in range(first, batches):
        store.write(_rows(spark, *range(n % 2, 40, 2), 1000 + n, price=float(n), minute=n), n)


def _expected(batches):
    out = {}
    for n in range(batches):
        out.update(dict.fromkeys([*range(n % 2, 40, 2), 1000 + n], float(n)))
    return out


def test_runs_are_merged_level_by_level(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=4, fan=2)
    for n in range(11):
        _fill(spark, store, n + 1, n)
        assert len(store.live()) == bin(n + 1).count("1")
    assert [(r.first, r.end) for r in store.live()] == [(0, 8), (8, 10), (10, 11)]
    assert _prices(store) == _expected(11)


def test_reads_do_not_grow_with_batches(spark, tmp_path):
    few, many = (FeatureStore(spark, str(tmp_path / n), buckets=4, fan=3) for n in "ab")
    _fill(spark, few, 3)
    _fill(spark, many, 27)
    assert len(few.read().inputFiles()) == len(many.read().inputFiles()) == 4
    assert _prices(many) == _expected(27)


def test_a_replay_changes_nothing(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=4, fan=4)
    _fill(spark, store, 6)
    before, live = _prices(store), store.live()
    for n in (0, 3, 4, 5):  # merged ones and single ones
        _fill(spark, store, n + 1, n)
    assert _prices(store) == before and store.live() == live


def test_a_run_without_its_marker_does_not_count(spark, tmp_path, monkeypatch):
    """A writer that dies between the rows and the marker, then tries again."""
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=4)
    _fill(spark, store, 1)
    create = Folder.create

    def lost(self, name):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(Folder, "create", lost)
    with pytest.raises(RuntimeError):
        _fill(spark, store, 2, 1)
    assert _prices(store) == _expected(1)
    monkeypatch.setattr(Folder, "create", create)
    _fill(spark, store, 2, 1)
    assert _prices(store) == _expected(2)


def test_empty_batches_and_empty_stores(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=4, fan=2)
    assert store.read().count() == 0
    requests = _rows(spark, 1, 2).select(F.lit("r").alias("request_id"), *FEATURE_KEY_COLUMNS)
    assert [r.found for r in store.lookup(requests).collect()] == [False, False]
    store.write(_rows(spark, 1), 1)  # batch 0 had no rows
    assert _prices(store) == {1: 1.0}
    store.write(_rows(spark), 2)
    store.write(_rows(spark, 2), 3)
    assert _prices(store) == {1: 1.0, 2: 1.0} and len(store.live()) == 1


def test_streams_have_runs_of_their_own(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=4, fan=2)
    store.write(_rows(spark, 1, 2), 0)
    store.write(_rows(spark, 2, price=9.0, minute=5), 0, stream="second")
    assert _prices(store) == {1: 1.0, 2: 9.0} and len(store.live()) == 2


def test_buckets_are_those_of_the_table(spark, tmp_path):
    place = str(tmp_path / "t")
    _fill(spark, FeatureStore(spark, place, buckets=4), 2)
    again = FeatureStore(spark, place, buckets=32)
    assert again.buckets == 4 and _prices(again) == _expected(2)
    other = FeatureStore(spark.newSession(), place)
    assert other.buckets == 4 and _prices(other) == _expected(2)


def test_vacuum_deletes_what_was_merged(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=4, fan=2)
    _fill(spark, store, 4)
    gone = store.vacuum()
    assert sorted(gone) == sorted(f"run={Run('main', a, b).name}" for a, b in ((0, 1), (0, 2), (1, 2), (2, 3), (2, 4), (3, 4)))
    assert _prices(store) == _expected(4) and store.vacuum() == []


def _shuffles_above_features(df):
    """Exchanges between the scan of the store and the first join above it."""
    plan = df._jdf.queryExecution().executedPlan()
    lines = plan.toString().split("\n")
    depth = lambda line: len(re.match(r"[\s:+\-|*()0-9]*", line)[0])
    found, scans = 0, 0
    for n, line in enumerate(lines):
        if "FileScan" not in line or "features_" not in line:
            continue
        scans += 1
        level = depth(line)
        for above in reversed(lines[:n]):
            if depth(above) < level:
                level = depth(above)
                if "Join" in above:
                    break
                found += "Exchange" in above
    assert scans
    return found


@pytest.mark.parametrize("buckets, partitions", [(16, 8), (16, 200), (4, 8)])
def test_lookup_does_not_shuffle_the_store(spark, tmp_path, buckets, partitions):
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=buckets)
    _fill(spark, store, 5)
    requests = _rows(spark, *range(50)).select(F.lit("r").alias("request_id"), *FEATURE_KEY_COLUMNS)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        looked = store.lookup(requests)
        assert _shuffles_above_features(looked) == 0
        assert sum(r.found for r in looked.collect()) == 40
        # the plain table, for comparison, is shuffled
        plain = feature_lookup(requests, newest_per_key(_rows(spark, *range(40))))
        assert plain.where("found").count() == 40
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_requests_are_answered_as_a_whole(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "t"), buckets=4)
    store.write(_rows(spark, 1, 2), 0)
    asked = [("a", 1), ("a", 2), ("b", 1), ("b", 99), ("c", 99)]
    rows = _rows(spark, 1, 2, 99).select(*FEATURE_KEY_COLUMNS)
    requests = spark.createDataFrame(asked, "request_id string, user_id long").join(rows, "user_id")
    found = {(r.request_id, r.user_id): (r.found, r.batch_ok) for r in answered(store.lookup(requests)).collect()}
    assert found == {
        ("a", 1): (True, True), ("a", 2): (True, True), ("b", 1): (True, False),
        ("b", 99): (False, False), ("c", 99): (False, False),
    }
