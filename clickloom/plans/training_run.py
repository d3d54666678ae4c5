"""A whole training run: features in, registered model out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.plans import preparation, training
from clickloom.plans.features import in_test_set, training_projection
from clickloom.schemas import FEATURE_KEY_COLUMNS, LABEL
from clickloom.session import stored

#: Shares of the rows: TEST to measure on, and of the others STOP to end boosting by.
TEST, STOP = 0.2, 0.2
STOP_SEED = 43


def with_part(features: DataFrame, key: list[str]) -> DataFrame:
    """Adds `part`: 'train', 'stop' or 'test', by hashes of the key."""
    part = (
        F.when(in_test_set(key, TEST), "test")
        .when(in_test_set(key, STOP, STOP_SEED), "stop")
        .otherwise("train")
    )
    return features.withColumn("part", part)


def prepared_parts(
    features: DataFrame, key: list[str], null_policy: str = "unseen"
) -> tuple[preparation.Preparation, DataFrame]:
    """What was learned from the training rows, and all rows prepared by it, stored."""
    parts = stored(
        with_part(features, key).select("part", *training_projection(features).columns), "parts"
    )
    learned = preparation.learn(parts.where("part = 'train'"), null_policy)
    rows = learned.apply(parts).withColumn("held_out", F.col("part") == "stop")
    return learned, stored(rows, "prepared")


def train_and_register(
    features: DataFrame,
    registry: str,
    artifacts: str,
    run_id: str,
    training_date: str,
    trials: int = training.NUM_TRIALS,
    rounds: int = 1,
    seed: int = 42,
    null_policy: str = "unseen",
    key: tuple[str, ...] = tuple(FEATURE_KEY_COLUMNS),
) -> training.RunResult:
    """Prepare, search, train, measure and register.

    The search and the trees see the training rows, boosting ends by the stop rows,
    and the metrics are those of the test rows. Preparation, model and the history of
    the metrics lie below `artifacts`/`run_id`; the registry, created if absent, gets
    its row only when all are there. What goes wrong is returned, not hidden; once the
    model is saved, with its path, metrics and parameters.
    """
    spark = features.sparkSession
    folder = f"{artifacts}/{run_id}"
    try:
        training.open_registry(spark, registry)
        learned, rows = prepared_parts(features, list(key), null_policy)
        learned.save(folder)

        tried = training.random_search(rows.where("part = 'train'"), trials, rounds, seed)
        best = training.best_trial(tried).first()
        tuned = {name: best[name] for name in training.SEARCH_SPACE} if best else None
        params = training.final_params(tuned, seed)
        params = {**params, "max_depth": int(params["max_depth"])}

        seen = rows.where("part <> 'test'")
        settings = {**params, "num_boost_round": rounds}
        model = training.train(seen, settings, validation="held_out", seed=seed)
        test = rows.where("part = 'test'")
        metrics = {r.metric: r.value for r in training.evaluate(model, test, LABEL).collect()}
        sets = {part: rows.where(F.col("part") == part) for part in ("train", "test")}
        history = training.metric_history(model, sets, run_id)
        history.coalesce(1).write.mode("overwrite").parquet(f"{folder}/history")
        training.save_model(model, f"{folder}/model")
    except Exception as problem:
        return training.RunResult("error", error=str(problem))
    done = (f"{folder}/model", metrics, params)
    try:
        training.commit_model(
            spark, registry, training.MODEL_NAME, f"{folder}/model", metrics, training_date
        )
    except Exception as problem:
        return training.RunResult("partial_success", *done, error=str(problem))
    return training.RunResult("success", *done)
