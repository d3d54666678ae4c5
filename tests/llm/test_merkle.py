import duckdb
import pytest
from pyspark.sql import functions as F

from clickloom.llm import merkle
from clickloom.llm.oracle import ORACLE
from clickloom.llm.queries import QUERIES

PAGE = "page_id long, url string, html string"


def against_duckdb(spark, name, sf):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted((tuple(map(str, row)) for row in cursor.fetchall()))
    found = QUERIES[name](spark, sf)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(tuple(map(str, r)) for r in found.select(columns).collect()) == expected
    return expected


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    against_duckdb(spark, "op1_merkle_audit", f"/root/testdata/{sf}")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(n, f"http://h/{n}", f"<p>{'x' * (n * 37 % 900)}</p>") for n in range(0, 5000, 3)]
    rows += [(None, "u", "v"), (None, None, None), (9, None, "n"), (12, "u", None), (15, "", ""), (15, "", "")]
    rows += [(20_000, "long", "y" * 400_000)]
    frame = spark.createDataFrame(rows, PAGE)
    return frame.withColumns({c: F.lit("clash") for c in ("archive", "digest", "number", "level")})


def test_equal_replicas_differ_nowhere(pages):
    records = merkle.archived(pages)
    assert records.count() == pages.count()
    assert merkle.audit(records, records).count() == 0


def test_every_planted_damage_is_found_and_nothing_else(pages):
    records = merkle.archived(pages)
    damaged = (
        records.filter(~F.col("page_id").eqNullSafe(F.lit(300)))
        .withColumn("digest", F.when(F.col("page_id") == 4800, F.lit("bad")).otherwise(F.col("digest")))
        .withColumn("record_offset", F.col("record_offset") + F.when(F.col("page_id") == 20_000, 1 << 30).otherwise(0))
    )
    rows = merkle.audit(records, damaged).collect()
    assert sorted((r.page_id, r.status) for r in rows) == [
        (300, "missing"),
        (4800, "altered"),
        (20_000, "extra"),
        (20_000, "missing"),
    ]


def test_only_branches_with_a_difference_are_read(pages, monkeypatch):
    records = merkle.archived(pages)
    damaged = records.withColumn("digest", F.when(F.col("page_id") == 3, F.lit("bad")).otherwise(F.col("digest")))
    sizes, real = [], merkle.stored

    def counted(frame, label):
        out = real(frame, label)
        if label == "different":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(merkle, "stored", counted)
    assert merkle.audit(records, damaged).count() == 1
    assert len(sizes) > 2 and set(sizes) == {1}


def test_empty_tables(spark, pages):
    none = merkle.archived(spark.createDataFrame([], PAGE))
    assert merkle.audit(none, none).count() == 0
    rows = merkle.audit(merkle.archived(pages), none).collect()
    assert len(rows) == pages.count() and {r.status for r in rows} == {"missing"}
