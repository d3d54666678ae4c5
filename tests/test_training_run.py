"""From features to scored requests with the stored model and mapping."""

import pytest
from pyspark.sql import functions as F

from clickloom.plans import preparation, training
from clickloom.plans.features import as_online
from clickloom.plans.scoring import batch_score, model_scorer
from clickloom.plans.training_run import train_and_register
from clickloom.schemas import FEATURE_COLUMNS, FEATURE_KEY_COLUMNS, LABEL


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run") / "features")
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    spark.range(1500).select(
        F.col("id").alias("user_id"), draw(1, 50).alias("product_id"),
        F.concat(F.lit("s"), "id").alias("user_session"),
        F.concat(F.lit("Brand#"), draw(2, 6)).alias("brand"),
        F.when(draw(8, 20) > 0, draw(3, 100).cast("double")).alias("price"), draw(4, 7).cast("int").alias("event_weekday"),
        F.when(draw(5, 3) > 0, "home").alias("category_code_level1"),
        F.concat(F.lit("c."), draw(6, 4)).alias("category_code_level2"),
        draw(7, 9).alias("activity_count"),
        (draw(3, 100) > 60).cast("int").alias(LABEL),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_run(spark, features, tmp_path):
    registry, artifacts = str(tmp_path / "registry"), str(tmp_path / "artifacts")
    for run, policy in (("r1", "unknown"), ("r2", "unseen")):
        result = train_and_register(
            features, registry, artifacts, run, "2024-02-01", 2, 3, null_policy=policy
        )
        assert result.status == "success", result.error
        assert result.metrics["auc"] > 0.9
        history = spark.read.parquet(f"{artifacts}/{run}/history")
        assert {(r.part, r.metric) for r in history.collect()} >= {("train", "auc"), ("test", "boosting_loss")}
    learned = preparation.load(spark, f"{artifacts}/r1")
    assert learned.null_policy == "unknown" and learned.median is not None
    assert "unknown" in {r.value for r in learned.mapping.collect()}
    current = training.latest_model(spark.read.schema(training.REGISTRY).parquet(registry)).first()
    assert (current.version, current.model_uri) == (2, f"{artifacts}/r2/model")

    model = training.load_model(spark, current.model_uri)
    stored = preparation.load(spark, f"{artifacts}/r2").apply(
        features.select(*FEATURE_KEY_COLUMNS, *FEATURE_COLUMNS)
    )
    requests = features.where("user_id < 100").select(
        F.concat(F.lit("q"), F.col("user_id") % 10).alias("request_id"), *FEATURE_KEY_COLUMNS
    )
    scored = batch_score(requests, stored, model_scorer(model))
    assert scored.where("success").count() == 100
    found = scored.join(features, FEATURE_KEY_COLUMNS).groupBy(LABEL).agg(F.avg("prediction")).collect()
    by_label = {r[0]: r[1] for r in found}
    assert by_label[1] > by_label[0]


def test_an_unseen_brand_is_still_scored(spark, features):
    mapping = spark.createDataFrame([], "col_name string, value string, idx int")
    row = preparation.Preparation(mapping, 7.5, "unseen").apply(features.where("price is null")).first()
    assert row.brand == -1.0 and row.price == 7.5


@pytest.mark.parametrize("policy", preparation.NULL_POLICIES)
def test_scoring_prepares_as_training_did(spark, features, tmp_path, policy):
    """The same rows, typed for training and as text for scoring, give the same inputs."""
    learned = preparation.learn(features, policy)
    learned.save(str(tmp_path / "p"))
    loaded = preparation.load(spark, str(tmp_path / "p"))
    stamped = features.withColumn("event_timestamp", F.lit("2024-01-01 00:00:00"))
    online = as_online(stamped).join(
        features.select("user_session", *FEATURE_KEY_COLUMNS[:2]), "user_session"
    )
    names = [*FEATURE_KEY_COLUMNS, *FEATURE_COLUMNS]
    trained = {tuple(r) for r in learned.apply(features).select(names).collect()}
    served = {tuple(r) for r in loaded.apply(online).select(names).collect()}
    assert trained == served and len(served) == features.count()
    missing = {r.price for r in learned.apply(features.where("price is null")).collect()}
    assert missing == {learned.median}


def test_a_failing_run_reports_and_registers_nothing(spark, features, tmp_path):
    registry = str(tmp_path / "registry")
    result = train_and_register(features.drop("price"), registry, str(tmp_path / "a"), "r", "2024-02-01")
    assert result.status == "error" and "price" in result.error
    assert spark.read.schema(training.REGISTRY).parquet(registry).count() == 0


def test_untuned_runs_sample_their_parameters():
    assert training.final_params(None, 3) == training.sample_params(3)
    assert training.final_params({"max_depth": 4}, 3) == {"max_depth": 4}


def test_a_saved_model_that_is_not_registered_is_reported(features, tmp_path, monkeypatch):
    def broken(*_):
        raise OSError("registry is gone")

    monkeypatch.setattr(training, "register_model", broken)
    result = train_and_register(features, str(tmp_path / "registry"), str(tmp_path / "a"), "r", "2024-02-01")
    assert result.status == "partial_success" and "registry is gone" in result.error
    assert result.model_path == f"{tmp_path}/a/r/model" and (tmp_path / "a/r/model").exists()
    assert 0 <= result.metrics["auc"] <= 1 and result.best_params["max_depth"] in (3, 4)
