from pyspark.sql import functions as F

from clickloom.plans.scoring import NOT_FOUND, batch_score, linear_score, status_counts

FEATURES = (
    "user_id long, product_id long, user_session string, brand double, price double, "
    "event_weekday double, category_code_level1 double, category_code_level2 double, "
    "activity_count double"
)


def _linear(inputs):
    return inputs.withColumn("prediction", linear_score())


def _score(spark, requests):
    features = spark.createDataFrame(
        [(1, 1, "a", 0.0, 1000.0, 0.0, 0.0, 0.0, 0.0), (1, 2, "a", 0.0, 0.0, 0.0, 0.0, 0.0, 20.0)],
        FEATURES,
    )
    df = spark.createDataFrame(
        requests, "request_id string, user_id long, product_id long, user_session string"
    )
    return batch_score(df, features, _linear)


def test_one_missing_key_fails_the_whole_request(spark):
    rows = _score(
        spark, [("ok", 1, 1, "a"), ("ok", 1, 2, "a"), ("bad", 1, 1, "a"), ("bad", 1, 9, "a")]
    ).collect()
    ok = [r for r in rows if r.request_id == "ok"]
    bad = [r for r in rows if r.request_id == "bad"]
    assert [r.prediction for r in ok] == [0.5, 0.5] and all(r.error is None for r in ok)
    assert all(r.prediction is None and r.error == NOT_FOUND and not r.success for r in bad)


def test_a_null_key_is_a_miss(spark):
    [row] = _score(spark, [("x", 1, 1, None)]).collect()
    assert not row.success


def test_status_counts(spark):
    scored = _score(spark, [("a", 1, 1, "a"), ("b", 1, 9, "a"), ("c", 1, 2, "a"), ("c", 1, 1, "a")])
    found = {r.success: (r.n, r["keys"]) for r in status_counts(scored).collect()}
    assert found == {True: (2, 3), False: (1, 1)}


def test_repeated_keys_stay(spark):
    scored = _score(spark, [("a", 1, 1, "a"), ("a", 1, 1, "a")])
    assert scored.count() == 2
    assert scored.where(F.col("prediction") == 0.5).count() == 2
