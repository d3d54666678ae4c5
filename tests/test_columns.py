import datetime
import math

import pytest
from pyspark.sql import functions as F

from clickloom.functions import columns as C


def _one(spark, values, dtype, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [tuple(r) for r in df.select(*expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1.5", 1.5), (" 2 ", 2.0), ("1_000", 1000.0), ("+.5", 0.5), ("5.", 5.0), ("1e3", 1000.0),
        ("1d", 0.0), ("1f", 0.0), ("1__0", 0.0), ("_1", 0.0), ("", 0.0), ("None", 0.0), (None, 0.0),
        ("Brand#3", 0.0), ("inf", math.inf), ("-Infinity", -math.inf), ("\t7\n", 7.0), ("0x1", 0.0),
        ("1.0E7", 1e7), ("1e400", math.inf),
    ],
)
def test_number_or_zero(spark, text, expected):
    [(value,)] = _one(spark, [text], "string", lambda x: [C.number_or_zero(x)])
    assert value == expected


def test_nan_text_is_a_number(spark):
    for text in ("nan", "NaN", "-nan"):
        [(value,)] = _one(spark, [text], "string", lambda x: [C.number_or_zero(x)])
        assert math.isnan(value)


def test_category_parts(spark):
    codes = ["a.b.c", "a.b.c.d", "a.b", "a", None]
    pairs = _one(spark, codes, "string", lambda x: C.category_head_tail(x))
    assert pairs == [("a", "b.c"), ("a", "b.c.d"), ("a", "b"), ("a", None), (None, None)]
    levels = _one(spark, codes, "string", lambda x: C.category_levels(x))
    assert levels == [
        ("a", "b", "c"), ("a", "b", "c.d"), ("a", "b", None), ("a", None, None), (None, None, None),
    ]


def test_price_tier_bounds(spark):
    prices = [99.99, 100.0, 499.99, 500.0, 949.0, 950.0, None]
    tiers = [t for (t,) in _one(spark, prices, "double", lambda x: [C.price_tier(x)])]
    assert tiers == ["budget", "standard", "standard", "premium", "premium", "luxury", None]


def test_weekday_starts_on_monday(spark):
    days = [datetime.date(2024, 1, 1), datetime.date(2024, 1, 7)]
    assert _one(spark, days, "date", lambda x: [C.weekday(x)]) == [(0,), (6,)]


def test_timestamps(spark):
    texts = ["2024-02-29 10:00:00", "2023-02-29 10:00:00", "soon", "", None]
    parsed = [v for (v,) in _one(spark, texts, "string", lambda x: [C.parsed_timestamp(x)])]
    assert parsed == [datetime.datetime(2024, 2, 29, 10), None, None, None, None]


def test_wall_seconds_ignore_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 02:30:00' AS t")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = []
        for zone in ("UTC", "Europe/Paris", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.append(df.select(C.wall_seconds(F.col("t"))).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert set(found) == {1711852200}


def test_records_that_look_alike_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("", "a"), ("-", "a"), ("1:a", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    hashes = [r[0] for r in df.select(C.record_hash(["x", "y"])).collect()]
    assert len(set(hashes)) == len(rows)
    assert all(len(h) == 64 for h in hashes)


def test_feature_key(spark):
    df = spark.createDataFrame([(1, 2, "s"), (1, None, "s")], "u long, p long, s string")
    keys = [r[0] for r in df.select(C.feature_key(F.col("u"), F.col("p"), F.col("s"))).collect()]
    assert keys == ["user:1:product:2:session:s", None]
