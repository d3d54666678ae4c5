"""Lookups skip row groups by every column that the layout names."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickloom.plans import warehouse
from clickloom.sources.indexed import clustered, interleaved, write_indexed

ROWS, FILES = 200_000, 64


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    """A third of the rows are one user's; sessions have some ten events."""
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    user = F.when(draw(1, 3) == 0, 7).otherwise(draw(2, 5000) + 10)
    df = spark.range(ROWS).select(
        F.md5(F.col("id").cast("string")).alias("event_key"),
        F.when(draw(3, 4) == 0, "cart").otherwise("view").alias("event_type"),
        user.cast("long").alias("user_id"),
        draw(4, 3000).alias("product_id"),
        (draw(4, 3000) % 40).alias("category_id"),
        F.lit("2024-01-01").cast("date").alias("event_date"),
        F.concat_ws("-", user, draw(5, 30).cast("string")).alias("user_session"),
    )
    path = str(tmp_path_factory.mktemp("fact") / "t")
    warehouse.write_fact(df, path, files=FILES)
    return spark.read.parquet(path), path


def _rows_read(df):
    """Rows that the scan took from its row groups, after the filter on their contents."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, found = [plan], []
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif "Scan" in node.getClass().getSimpleName():
            found.append(node.metrics().apply("numOutputRows").value())
        else:
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
    return sum(found)


@pytest.mark.parametrize(
    "column, value, most",
    [("user_id", 77, 0.35), ("product_id", 1234, 0.35), ("user_session", "77-3", 0.35)],
)
def test_lookups_skip_row_groups(spark, fact, column, value, most):
    rows, path = fact
    whole = spark.read.parquet(path)
    wanted = rows.where(F.col(column) == value)
    n = whole.where(F.col(column).cast("string").isin(str(value))).count()  # this filter skips nothing
    assert wanted.count() == n > 0
    assert _rows_read(rows.where(F.col(column) == value)) < most * ROWS


def test_a_value_that_is_nowhere_reads_nothing(fact):
    rows, _ = fact
    assert _rows_read(rows.where("user_id = 6")) == 0
    assert _rows_read(rows.where("product_id = 2999999")) == 0


def test_a_plain_layout_skips_nothing(spark, fact, tmp_path):
    rows, _ = fact
    rows.repartition(FILES).write.parquet(str(tmp_path / "plain"))
    assert _rows_read(spark.read.parquet(str(tmp_path / "plain")).where("product_id = 1234")) > 0.45 * ROWS


def test_a_hot_user_is_spread(fact):
    _, path = fact
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert len(sizes) > FILES / 2 and max(sizes) < 4 * ROWS / len(sizes)


def test_partitions_and_the_partial_table(spark, fact, tmp_path):
    rows, _ = fact
    days = rows.withColumn("event_date", F.date_add("event_date", (F.col("product_id") % 5).cast("int")))
    warehouse.write_fact(days, str(tmp_path / "days"), ["event_date"])
    again = spark.read.parquet(str(tmp_path / "days"))
    assert again.where("event_date = '2024-01-03'").count() == days.where("product_id % 5 = 2").count()
    warehouse.write_cart_purchases(rows, str(tmp_path / "cart"), files=16)
    cart = spark.read.parquet(str(tmp_path / "cart"))
    assert cart.columns == ["event_type", "user_session", "product_id", "event_key", "event_date"]
    assert cart.count() == rows.where("event_type = 'cart'").count()
    assert _rows_read(cart.where("user_session = '77-3'")) < 0.5 * cart.count()


def test_places_interleave_the_slots(spark):
    rows = spark.range(1000).select(
        F.col("id").alias("a"), F.when(F.col("id") % 9 > 0, F.col("id") % 13).alias("b")
    )
    slots = [F.pmod(F.xxhash64(c), F.lit(8)).alias(f"s_{c}") for c in "ab"]
    for r in rows.select("*", *slots, interleaved(["a", "b"], 3).alias("place")).collect():
        bits = "".join(f"{r.s_a:03b}"[i] + f"{r.s_b:03b}"[i] for i in range(3))
        assert r.place == int(bits, 2)
    assert clustered(rows, ["a", "b"]).exceptAll(rows).count() == 0


def test_odd_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (1, None), (None, "x")], "k long, s string")
    write_indexed(rows, str(tmp_path / "t"), ["k", "s"])
    again = spark.read.parquet(str(tmp_path / "t"))
    assert again.count() == 3 and again.where("s = 'x'").count() == 1
    write_indexed(rows.limit(0), str(tmp_path / "none"), ["k"])
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
