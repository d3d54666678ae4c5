import math

from pyspark.sql import functions as F

from clickloom.operators.encode import (
    category_mapping,
    encode_categories,
    fill_categories,
    load_mapping,
    save_mapping,
)
from clickloom.operators.lookup import numeric_features
from clickloom.plans.features import as_online, fill_missing, in_test_set, train_test_split
from clickloom.plans.preparation import Preparation
from clickloom.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS

SCHEMA = (
    "user_id long, product_id long, user_session string, event_timestamp timestamp_ntz, "
    "brand string, price double, event_weekday int, category_code_level1 string, "
    "category_code_level2 string, activity_count long, is_purchased int"
)


def _frame(spark):
    import datetime

    t = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [
            (1, 1, "a", t, "zeta", 1.0, 10, "b", "x.y", 1, 0),
            (1, 2, "a", t, "Alpha", 2.0, 2, "a", None, 1, 1),
            (2, 1, "b", t, "émile", 3.0, 0, "b", "x", 2, 0),
            (2, 2, "b", t, None, 10.0, None, None, "x.y", 2, 1),
        ],
        SCHEMA,
    )


def test_mapping_is_sorted_and_gapless(spark):
    rows = category_mapping(_frame(spark).repartition(3)).collect()
    by_column = {}
    for r in sorted(rows, key=lambda r: r.idx):
        by_column.setdefault(r.col_name, []).append(r.value)
    assert by_column["brand"] == ["Alpha", "zeta", "émile"]
    assert by_column["event_weekday"] == ["0", "2", "10"]
    assert by_column["category_code_level2"] == ["x", "x.y"]
    for name in CATEGORICAL_COLUMNS:
        assert [r.idx for r in sorted(rows, key=lambda r: r.idx) if r.col_name == name] == list(
            range(len(by_column[name]))
        )


def test_unseen_and_null_are_minus_one(spark):
    frame = _frame(spark)
    mapping = category_mapping(frame.where("brand != 'zeta'"))
    rows = encode_categories(frame, mapping).orderBy("user_session", "product_id").collect()
    assert [r.brand for r in rows] == [-1, 0, 1, -1]
    assert rows[3].event_weekday == -1 and rows[0].category_code_level2 == -1


def test_training_and_scoring_see_the_same_vector(spark, tmp_path):
    frame = _frame(spark)
    save_mapping(category_mapping(frame), str(tmp_path / "mapping"))
    mapping = load_mapping(spark, str(tmp_path / "mapping"))
    keys = ["user_session", "product_id"]

    def vectors(df):
        rows = df.select(*keys, *[F.col(c).cast("double") for c in FEATURE_COLUMNS]).collect()
        return {(r.user_session, int(r.product_id)): tuple(r)[2:] for r in rows}

    learned = Preparation(mapping, None, "unseen")
    trained = vectors(learned.apply(frame))
    stored = as_online(frame).withColumn("product_id", F.split("feature_key", ":")[3])
    assert vectors(learned.apply(stored)) == trained
    raw = vectors(numeric_features(stored))
    assert raw[("a", 1)] == (0.0, 1.0, 10.0, 0.0, 0.0, 1.0)


def test_fill_missing(spark):
    frame = _frame(spark).withColumn(
        "price", F.when(F.col("price") == 3.0, F.lit(math.nan)).otherwise(F.col("price"))
    )
    rows = fill_missing(frame).orderBy("user_session", "product_id").collect()
    assert [r.price for r in rows] == [1.0, 2.0, 2.0, 10.0]
    assert rows[3].brand == "unknown" and rows[3].category_code_level1 == "unknown"
    assert rows[3].event_weekday is None
    assert fill_categories(frame).schema["event_weekday"].dataType.typeName() == "integer"


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(20_000)
    train, test = train_test_split(df, ["id"])
    assert train.count() + test.count() == 20_000
    assert train.intersect(test).isEmpty()
    assert 0.18 < test.count() / 20_000 < 0.22
    again = df.repartition(13).where(in_test_set(["id"]))
    assert again.exceptAll(test).isEmpty() and test.exceptAll(again).isEmpty()
    other = df.where(in_test_set(["id"], seed=7))
    assert not other.exceptAll(test).isEmpty()
