"""Star schema: dimensions, fact and the two reporting views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import (
    category_levels,
    is_valid,
    price_tier,
    record_hash,
    record_key,
)
from clickloom.operators.sessions import with_session_counts
from clickloom.operators.upsert import latest_per_key
from clickloom.schemas import FACT_EVENTS, RAW_EVENT
from clickloom.session import stored
from clickloom.sources.indexed import write_indexed

# What makes two raw events the same record.
CONTENT_FIELDS = [
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
]
RECORD_FIELDS = [
    "event_id",
    "event_timestamp",
    "event_type",
    "user_id",
    "product_id",
    "user_session",
    "category_id",
    "price",
]


def dim_user(users: DataFrame) -> DataFrame:
    return users.select("user_id").distinct()


def dim_product(products: DataFrame) -> DataFrame:
    price = F.col("price").cast("decimal(10,2)")
    return products.select("product_id", "brand", price.alias("price")).withColumn(
        "price_tier", price_tier(F.col("price"))
    )


def dim_category(products: DataFrame) -> DataFrame:
    """One row per category id: the newest code it came with, if there are times, or
    else the greatest; null only where it never had one."""
    level1, level2, level3 = category_levels(F.col("category_code"))
    time = F.col("event_timestamp") if "event_timestamp" in products.columns else F.lit(0)
    coded = F.struct(F.col("category_code").isNotNull(), time, "category_code")
    return (
        products.where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.max(coded)["category_code"].alias("category_code"))
        .withColumns({"category_l1": level1, "category_l2": level2, "category_l3": level3})
    )


def dim_date(events: DataFrame) -> DataFrame:
    """One row per calendar day; the hour lives on the fact."""
    return (
        events.select(F.to_date("event_timestamp").alias("event_date"))
        .where(F.col("event_date").isNotNull())
        .distinct()
        .withColumn("day_of_week", F.date_format("event_date", "EEEE"))
    )


def raw_records(events: DataFrame, source: str) -> DataFrame:
    """Raw events as they are stored: with hash, validity and where they came from."""
    required = [f.name for f in RAW_EVENT.fields if not f.nullable and f.name in CONTENT_FIELDS]
    return events.withColumns(
        {
            "processed_date": F.current_timestamp(),
            "processing_pipeline": F.lit(source),
            "valid": is_valid(required).cast("string"),
            "record_hash": record_hash(CONTENT_FIELDS),
        }
    ).select(RAW_EVENT.fieldNames())


def fact_events(events: DataFrame) -> DataFrame:
    if "events_in_session" not in events.columns:
        events = with_session_counts(events)
    return events.withColumns(
        {
            "event_key": record_key([c for c in RECORD_FIELDS if c in events.columns]),
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
        }
    ).select(FACT_EVENTS.fieldNames())


def write_star_schema(events: DataFrame, root: str) -> None:
    """Writes fact and dimensions, taken from raw events, below `root`.

    The source is read once and landed as parquet, from which each table reads its
    columns. Rows alike in all columns are one event. The fact is partitioned by day
    and laid out for lookups by user, product, category and session; the events that cart
    reports read lie beside it once more, by session and product. Price and brand of a
    product are those of its newest event.
    """
    events = stored(events.distinct(), "raw-events")
    products = latest_per_key(
        events.where(F.col("product_id").isNotNull()).select(
            "product_id", "brand", "price", "event_timestamp"
        ),
        ["product_id"],
        ["event_timestamp"],
    )
    dim_user(events.where(F.col("user_id").isNotNull())).write.parquet(f"{root}/dim_user")
    dim_product(products).write.parquet(f"{root}/dim_product")
    dim_category(events).write.parquet(f"{root}/dim_category")
    dim_date(events).write.parquet(f"{root}/dim_date")
    fact = stored(fact_events(events), "fact")
    write_fact(fact, f"{root}/fact_events", ["event_date"])
    write_cart_purchases(fact, f"{root}/fact_cart_purchase")


#: Columns that the fact is looked up by, beside its day, and those whose values place a row;
#: a category goes with its products.
FACT_LOOKUPS = ["user_id", "product_id", "category_id", "user_session"]
FACT_CLUSTERS = ["user_id", "product_id", "user_session"]
CART_PURCHASE = ("cart", "purchase")


def write_fact(fact: DataFrame, path: str, partition_by: Sequence[str] = (), **layout) -> None:
    """The fact laid out for lookups by each of FACT_LOOKUPS."""
    write_indexed(fact, path, FACT_CLUSTERS, FACT_LOOKUPS, partition_by, **layout)


def write_cart_purchases(
    fact: DataFrame, path: str, types: Sequence[str] = CART_PURCHASE, **layout
) -> None:
    """What a partial index holds: the rows and columns of `types`, by session and product."""
    rows = fact.where(F.col("event_type").isin(*types))
    columns = rows.select("event_type", "user_session", "product_id", "event_key", "event_date")
    write_indexed(columns, path, ["user_session", "product_id"], **layout)


def vw_user_session_summary(
    fact: DataFrame, dim_user: DataFrame, dim_date: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Events, first and last time and distinct products per user and session.

    The dimensions only filter (their keys are unique), so they are semi joins,
    placed where few rows are left: days on the scan, products after the rows of
    a session and product are folded, which also settles the distinct count and
    defuses a hot product, and users on the finished sessions. Only the calendar
    is broadcast by force; its days bound its size.
    """
    per_product = (
        fact.join(F.broadcast(dim_date.select("event_date")), "event_date", "left_semi")
        .groupBy("user_id", "user_session", "product_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("event_timestamp").alias("first_ts"),
            F.max("event_timestamp").alias("last_ts"),
        )
        .join(dim_product, "product_id", "left_semi")
    )
    return (
        per_product.groupBy("user_id", "user_session")
        .agg(
            F.sum("n").alias("event_count"),
            F.min("first_ts").alias("session_start"),
            F.max("last_ts").alias("session_end"),
            F.count(F.lit(1)).alias("unique_products_viewed"),
        )
        .join(dim_user, "user_id", "left_semi")
    )


def vw_category_performance(
    fact: DataFrame, dim_category: DataFrame, dim_user: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Events, distinct users and mean price per category.

    Folding to (category, user, product) comes before any join: a hot user
    shrinks to one row per product they touched.
    """
    folded = fact.groupBy("category_id", "user_id", "product_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    levels = ["category_l1", "category_l2", "category_l3"]
    priced = F.when(F.col("price").isNotNull(), F.col("n"))
    return (
        folded.join(dim_category.select("category_id", *levels), "category_id")
        .join(dim_product.select("product_id", "price"), "product_id")
        .join(dim_user, "user_id", "left_semi")
        .groupBy(*levels)
        .agg(
            F.sum("n").alias("view_count"),
            F.count_distinct("user_id").alias("unique_users"),
            (F.sum(F.col("price") * F.col("n")).cast("double") / F.sum(priced)).alias("avg_price"),
        )
    )


def cart_purchase_events(events: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Cart and purchase events; the predicate reaches the file scan."""
    return events.where(F.col("event_type").isin(*types))
