import pytest
from pyspark.sql import functions as F

from clickloom.catalog.queries import model_fits
from clickloom.plans import training as T
from clickloom.schemas import FEATURE_COLUMNS, LABEL


@pytest.fixture(scope="module")
def planted(spark):
    """Dear goods on weekdays 5 and 6 are bought, with some noise."""
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    df = spark.range(3000).select(
        "id",
        draw(1, 5).cast("double").alias("brand"),
        draw(2, 1000).cast("double").alias("price"),
        draw(3, 7).cast("double").alias("event_weekday"),
        draw(4, 4).cast("double").alias("category_code_level1"),
        draw(5, 9).cast("double").alias("category_code_level2"),
        draw(6, 10).cast("double").alias("activity_count"),
        (draw(7, 10) == 0).alias("noise"),
        (draw(8, 5) == 0).alias("held_out"),
    )
    bought = ((F.col("price") > 500) & (F.col("event_weekday") >= 5)) != F.col("noise")
    return df.withColumn(LABEL, bought.cast("int")).cache()


def _values(metrics):
    return {r.metric: r.value for r in metrics.collect()}


def test_learns_a_planted_rule_and_survives_saving(spark, planted, tmp_path):
    model = T.train(planted, {"max_depth": 3, "num_boost_round": 4}, validation="held_out")
    held = planted.where("held_out")
    metrics = _values(T.evaluate(model, held))
    assert metrics["auc"] > 0.75 and metrics["accuracy"] > 0.8
    T.save_model(model, str(tmp_path / "model"))
    again = T.load_model(spark, str(tmp_path / "model"))
    assert _values(T.evaluate(again, held)) == metrics


def test_history_has_one_value_per_round(planted):
    model = T.train(planted, {"max_depth": 2, "num_boost_round": 3})
    sets = {"train": planted, "test": planted.where("held_out")}
    history = T.metric_history(model, sets, "run-1")
    rows = history.where("part = 'train' AND metric = 'boosting_loss'").orderBy("step").collect()
    assert [r.step for r in rows] == [0, 1, 2]
    assert rows[-1].value < rows[0].value
    assert {(r.part, r.metric) for r in history.collect()} >= {("test", "auc"), ("train", "logloss")}


def test_search_is_repeatable_and_within_its_ranges(planted):
    trials = T.random_search(planted, trials=3, rounds=1, seed=5).collect()
    assert trials == T.random_search(planted, trials=3, rounds=1, seed=5, parallelism=1).collect()
    for t in trials:
        assert t.max_depth in (3, 4) and 1e-4 <= t.learning_rate <= 1e-1
        assert t.min_child_weight in (1, 2, 3, 4, 5) and 0 <= t.gamma <= 1
        assert 0.5 <= t.subsample <= 1 and 0.5 <= t.colsample_bytree <= 1
    assert len({t.learning_rate for t in trials}) == 3


def test_tuned_rate_replaces_its_alias():
    assert T.gbt_params({})["stepSize"] == 0.3
    assert T.gbt_params({"learning_rate": 0.01})["stepSize"] == 0.01


def test_best_trial_prefers_the_lower_id(spark):
    df = spark.createDataFrame(
        [(2, "b", 0.5), (1, "c", 0.5), (3, "a", 0.7)], "trial_id int, note string, train_rmse double"
    )
    assert T.best_trial(df).first().asDict() == {"trial_id": 1, "note": "c", "train_rmse": 0.5}


def test_registry(spark):
    registry = spark.createDataFrame([], T.REGISTRY)
    for version in (1, 2):
        row = T.register_model(registry, "m", f"runs:/{version}/model", {"auc": 0.7}, "2024-01-01")
        assert row.first().version == version
        registry = registry.unionByName(row)
    registry = registry.unionByName(
        T.register_model(registry, "other", "runs:/9/model", {}, "2024-01-01")
    )
    latest = {r.name: (r.version, r.model_uri, r.alias) for r in T.latest_model(registry).collect()}
    assert latest == {"m": (2, "runs:/2/model", "current"), "other": (1, "runs:/9/model", "current")}


def test_two_registrations_at_once_get_two_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "registry")
    T.open_registry(spark, path)

    def register(n):
        return T.commit_model(spark, path, "m", f"runs:/{n}/model", {"auc": 0.5}, "2024-01-01")

    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(register, range(12)))
    assert len(set(versions)) == 12
    rows = T.open_registry(spark, path).collect()
    assert sorted(r.version for r in rows) == sorted(versions) and len({r.model_uri for r in rows}) == 12
    assert T.commit_model(spark, path, "other", "runs:/x/model", {}, "2024-01-01") == 1
    assert T.latest_model(T.open_registry(spark, path)).where("name = 'm'").first().version == max(versions)


def test_a_version_that_was_lost_is_not_given_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "registry")
    assert T.commit_model(spark, path, "m", "runs:/1/model", {}, "2024-01-01") == 1
    register = T.register_model

    class Lost:
        def first(self):
            return register(T.open_registry(spark, path), "m", "", {}, "").first()

        def withColumn(self, *_):
            raise RuntimeError("executor lost")

    monkeypatch.setattr(T, "register_model", lambda *_: Lost())
    with pytest.raises(RuntimeError):
        T.commit_model(spark, path, "m", "runs:/2/model", {}, "2024-01-01")
    monkeypatch.setattr(T, "register_model", register)
    assert T.commit_model(spark, path, "m", "runs:/3/model", {}, "2024-01-01") == 3


def test_latest_model_file(spark):
    def newest(*names):
        df = spark.createDataFrame([(n,) for n in names], "file_name string")
        row = T.latest_model_file(df).first()
        return row and row.file_name

    assert newest("xgboost_model_31_12_2023.ubj", "xgboost_model_01_02_2024.ubj") == (
        "xgboost_model_01_02_2024.ubj"
    )
    assert newest("xgboost_model.ubj", "xgboost_model_30_02_2024.ubj") is None
    assert newest("b/xgboost_model_01_01_2024.ubj", "a/xgboost_model_01_01_2024.ubj") == (
        "a/xgboost_model_01_01_2024.ubj"
    )


def test_feature_order_is_the_stored_one():
    assert FEATURE_COLUMNS[0] == "brand" and LABEL not in FEATURE_COLUMNS


def _fits(spark, part, rows, model):
    draw = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    frame = spark.range(rows).withColumn("y", (draw < 0.2).cast("int"))
    frame = frame.select(F.lit(part).alias("part"), "y", model(F.col("y"), F.col("id")).alias("p"))
    return frame.agg(model_fits(F.col("part"), F.col("y"), F.col("p")).alias("fits")).first().fits


def test_a_useless_or_harmful_model_does_not_fit(spark):
    constant = lambda y, i: F.lit(0.2)
    harmful = lambda y, i: 0.2 + 0.19 * F.when(i % 2 == 0, 1).otherwise(-1)  # 23 % worse
    useful = lambda y, i: 0.2 + 0.1 * y
    assert not _fits(spark, "train", 2000, constant)
    assert not _fits(spark, "train", 2000, lambda y, i: 0.2 - 0.01 * y)
    for part in ("train", "stop", "test"):
        assert not _fits(spark, part, 100_000, harmful)
        assert _fits(spark, part, 100_000, useful)
    assert _fits(spark, "test", 200, constant)
