"""Click events, catalog and users derived from the shared test tables.

The tables hold no sessions, categories or products on events, so those come
from what is there: the product from the event's JSON, the category from the
part's type and name, the session from gaps in time. 'click' stands for 'cart'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.columns import category_id
from clickloom.operators.sessions import sessionize

CART_TYPES = ("click", "purchase")
PURCHASE_TYPE = "purchase"


# The columns read from each table. A given schema spares the job
# that would read file footers to find one.
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, "
    "p_retailprice double",
    "customer": "c_custkey long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's files as a stream. Written as a pattern, the path may be one
    file as well as a folder of files."""
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parque[t]")


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their product, before sessions and catalog."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        F.col("ts").alias("event_timestamp"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product: brand, price and category."""
    code = F.concat_ws(".", F.lower("p_type"), F.replace("p_name", F.lit(" "), F.lit(".")))
    return (
        table(spark, sf_dir, "part")
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("price"),
            code.alias("category_code"),
        )
        .withColumn("category_id", category_id(F.col("category_code")))
    )


def events_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog with the number of events of each product, for what depends
    on the product alone: a hot product is one row before it meets the catalog."""
    counts = (
        base_events(spark, sf_dir).groupBy("product_id").agg(F.count(F.lit(1)).alias("events"))
    )
    return counts.join(catalog(spark, sf_dir), "product_id", "left")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionize(base_events(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str, sessions: bool = True) -> DataFrame:
    """Events as a shop would send them: session, brand, price and category."""
    events = session_events(spark, sf_dir) if sessions else base_events(spark, sf_dir)
    return events.join(catalog(spark, sf_dir), "product_id", "left")
