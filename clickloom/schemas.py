"""Schemas, column lists and limits shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table layouts, column names and limits that a result must carry.
# ---------------------------------------------------------------------------

LANDED_EVENT = T.StructType(
    [
        T.StructField("event_timestamp", T.TimestampType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("user_session", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("category_code_level1", T.StringType(), True),
        T.StructField("category_code_level2", T.StringType(), True),
        T.StructField("event_weekday", T.LongType(), True),
        T.StructField("activity_count", T.LongType(), True),
        T.StructField("is_purchased", T.LongType(), True),
    ]
)

# A landed event with the id that settles which of two events of a second is newer.
LANDED_DOCUMENT = T.StructType([*LANDED_EVENT.fields, T.StructField("event_id", T.LongType(), True)])

NOTIFICATION = T.StructType([T.StructField("Key", T.StringType(), True)])

# nullable=False is the rule the `valid` flag checks; files do not enforce it.
RAW_EVENT = T.StructType(
    [
        T.StructField("event_time", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("product_id", T.LongType(), False),
        T.StructField("category_id", T.LongType(), False),
        T.StructField("category_code", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("user_session", T.StringType(), False),
        T.StructField("processed_date", T.TimestampType(), True),
        T.StructField("processing_pipeline", T.StringType(), True),
        T.StructField("valid", T.StringType(), True),
        T.StructField("record_hash", T.StringType(), False),
    ]
)

FACT_EVENTS = T.StructType(
    [
        T.StructField("event_key", T.StringType(), False),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("category_id", T.LongType(), True),
        T.StructField("event_date", T.DateType(), True),
        T.StructField("event_hour", T.IntegerType(), True),
        T.StructField("event_timestamp", T.TimestampNTZType(), True),
        T.StructField("user_session", T.StringType(), True),
        T.StructField("events_in_session", T.LongType(), True),
    ]
)

LABEL = "is_purchased"
FEATURE_COLUMNS = [
    "brand",
    "price",
    "event_weekday",
    "category_code_level1",
    "category_code_level2",
    "activity_count",
]
CATEGORICAL_COLUMNS = [
    "brand",
    "event_weekday",
    "category_code_level1",
    "category_code_level2",
]
ID_COLUMNS = ["event_timestamp", "user_id", "product_id", "user_session"]

FEATURE_KEY_COLUMNS = ["user_id", "product_id", "user_session"]
ONLINE_FIELDS = [
    "brand",
    "price",
    "event_weekday",
    "category_code_level1",
    "category_code_level2",
    "activity_count",
    "is_purchased",
    "user_session",
    "event_timestamp",
]

FILL_TEXT = "unknown"
UNSEEN_INDEX = -1

RAW_ROW_BOUNDS = (0, 1_000_000)
GOLD_ROW_BOUNDS = (1, 1_000_000)
MAX_DUPLICATES = 100
MIN_TOTAL = 100
MAX_TOTAL = 1_000_000
MAX_SECONDS = 3600
