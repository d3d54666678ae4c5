"""Training, tuning and tracking of the purchase classifier, on MLlib."""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.metrics import classification_metrics
from clickloom.plans import boosting, search
from clickloom.schemas import FEATURE_COLUMNS, LABEL
from clickloom.sources.files import Folder, existing

# ---------------------------------------------------------------------------
# Base parameters and search ranges.
# ---------------------------------------------------------------------------
BASE_PARAMS = {
    "max_depth": 1,
    "eta": 0.3,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "num_boost_round": 1,
}
SEARCH_SPACE = {
    "max_depth": ("integer", 3, 4),
    "learning_rate": ("log_uniform", 1e-4, 1e-1),
    "min_child_weight": ("choice", 1, 2, 3, 4, 5),
    "subsample": ("uniform", 0.5, 1.0),
    "colsample_bytree": ("uniform", 0.5, 1.0),
    "gamma": ("uniform", 0.0, 1.0),
}
NUM_TRIALS = 1
MODEL_NAME = "purchase_prediction_model"
MODEL_DESCRIPTION = "Gradient-boosted trees (MLlib) for purchase prediction"
MODEL_STAGE = "Staging"
MODEL_ALIAS = "current"

# Trainer parameter -> GBTClassifier parameter. A tuned learning_rate replaces
# eta, its alias, because it is merged later.
_GBT_NAMES = {
    "max_depth": "maxDepth",
    "eta": "stepSize",
    "learning_rate": "stepSize",
    "num_boost_round": "maxIter",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
    "min_child_weight": "minInstancesPerNode",
}


def sample_params(seed: int) -> dict[str, float]:
    """One point of the search space; the same for the same seed."""
    draw = random.Random(seed)
    point = {}
    for name, (kind, *bounds) in SEARCH_SPACE.items():
        if kind == "integer":
            point[name] = draw.randint(*bounds)
        elif kind == "choice":
            point[name] = draw.choice(bounds)
        elif kind == "uniform":
            point[name] = draw.uniform(*bounds)
        else:
            low, high = (math.log(b) for b in bounds)
            point[name] = math.exp(draw.uniform(low, high))
    return point


def gbt_params(params: dict[str, float]) -> dict[str, object]:
    translated = {}
    for name, value in {**BASE_PARAMS, **params}.items():
        value = str(value) if name == "colsample_bytree" else value
        translated[_GBT_NAMES[name]] = value
    return translated


def final_params(best: dict[str, float] | None, seed: int) -> dict[str, float]:
    """The tuned parameters, or a sampled point where tuning gave none."""
    return dict(best) if best else sample_params(seed)


def train(
    frame: DataFrame,
    params: dict[str, float] | None = None,
    validation: str | None = None,
    seed: int = 42,
    features: Sequence[str] = tuple(FEATURE_COLUMNS),
    label: str = LABEL,
) -> PipelineModel:
    """Boosted trees on encoded features.

    With `validation`, a boolean column, its rows are held out, and the ensemble is cut to
    the round with the best log loss of these, once PATIENCE further rounds gained
    nothing. Rounds are grown in spans that double: a longer fit begins with
    the same trees, so at most as many rounds are grown again as are needed.
    Trees are grown from per-partition histograms, so only bin statistics meet on
    the driver. Category indexes enter as numbers; a vocabulary of any size needs no
    more bins.
    """
    columns = [*features, label] + ([validation] if validation else [])
    rows = frame.select(*columns).withColumn(label, F.col(label).cast("double"))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    settings = gbt_params(params or {})
    wanted = settings.pop("maxIter")

    def grown(rows: DataFrame, rounds: int) -> PipelineModel:
        trees = GBTClassifier(labelCol=label, seed=seed, maxIter=rounds, **settings)
        return Pipeline(stages=[assembler, trees]).fit(rows)

    if not validation:
        return grown(rows, wanted)
    seen, held = rows.where(~F.col(validation)), rows.where(F.col(validation))
    rounds = min(wanted, 2 * boosting.PATIENCE)
    while True:
        model = grown(seen, rounds)
        best, ended = boosting.best_rounds(model, held, label)
        if ended or rounds >= wanted:
            return boosting.cut(model, best)
        rounds = min(wanted, 2 * rounds)


def score(model: PipelineModel, frame: DataFrame, name: str = "prediction_score") -> DataFrame:
    """Adds the purchase probability."""
    scored = model.transform(frame)
    probability = vector_to_array(F.col("probability"))[1]
    return scored.withColumn(name, probability).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def evaluate(model: PipelineModel, frame: DataFrame, label: str = LABEL) -> DataFrame:
    return classification_metrics(score(model, frame), label, "prediction_score")


def metric_history(
    model: PipelineModel, sets: dict[str, DataFrame], run_id: str, label: str = LABEL
) -> DataFrame:
    """(run_id, part, metric, step, value): all metrics of each set after every round."""
    history = boosting.metrics_by_round(model, sets, label)
    return history.select(F.lit(run_id).alias("run_id"), "part", "metric", "step", "value")


TRIALS = T.StructType(
    [
        T.StructField("trial_id", T.IntegerType(), False),
        *[T.StructField(name, T.DoubleType(), False) for name in SEARCH_SPACE],
        T.StructField("train_rmse", T.DoubleType(), False),
    ]
)


def random_search(
    frame: DataFrame,
    trials: int = NUM_TRIALS,
    rounds: int = 1,
    seed: int = 42,
    parallelism: int = 20,
    features: Sequence[str] = tuple(FEATURE_COLUMNS),
    label: str = LABEL,
) -> DataFrame:
    """One row per trial with its parameters and error.

    The rows are binned and folded once, and `parallelism` trials at a time share each pass
    over them; how many does not change what they find. Rows a trial does not sample
    take part in its error.
    """
    spark = frame.sparkSession
    points = [sample_params(seed + trial) for trial in range(trials)]
    cells, _ = search.binned(frame, features, label)
    errors: list[float] = []
    for start in range(0, trials, parallelism):
        some = [
            search.Trial(
                max_depth=point["max_depth"],
                learning_rate=point["learning_rate"],
                min_child_weight=point["min_child_weight"],
                subsample=point["subsample"],
                columns=point["colsample_bytree"],
                gamma=point["gamma"],
                seed=seed + start + n,
            )
            for n, point in enumerate(points[start : start + parallelism])
        ]
        errors += search.grown(cells, list(features), some, rounds)
    results = [
        (trial, *[float(point[name]) for name in SEARCH_SPACE], error)
        for trial, (point, error) in enumerate(zip(points, errors))
    ]
    return spark.createDataFrame(results, TRIALS)


def best_trial(trials: DataFrame, metric: str = "train_rmse") -> DataFrame:
    """The trial with the smallest error; level trials go to the lowest id."""
    rest = [c for c in trials.columns if c not in (metric, "trial_id")]
    return trials.agg(F.min(F.struct(metric, "trial_id", *rest)).alias("best")).select(
        *[F.col("best")[c].alias(c) for c in trials.columns]
    )


# ---------------------------------------------------------------------------
# Registry: an append-only table, one row per model version.
# ---------------------------------------------------------------------------
REGISTRY = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.IntegerType(), False),
        T.StructField("model_uri", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("training_date", T.StringType(), False),
        T.StructField("metrics", T.StringType(), True),
        T.StructField("stage", T.StringType(), False),
    ]
)


def open_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry at `path`, which is created if nothing is there."""
    if not existing(spark, [path]):
        spark.createDataFrame([], REGISTRY).write.mode("ignore").parquet(path)
    return spark.read.schema(REGISTRY).parquet(path)


def register_model(
    registry: DataFrame, name: str, model_uri: str, metrics: dict[str, float], training_date: str
) -> DataFrame:
    """The registry row of the next version of `name`, as far as `registry` tells."""
    spark = registry.sparkSession
    measured = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in metrics.items()]))
    last = registry.where(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0)))
    return spark.range(1).select(
        F.lit(name).alias("name"),
        (last.scalar() + 1).cast("int").alias("version"),
        F.lit(model_uri).alias("model_uri"),
        F.lit(MODEL_DESCRIPTION).alias("description"),
        F.lit(training_date).alias("training_date"),
        measured.alias("metrics"),
        F.lit(MODEL_STAGE).alias("stage"),
    )


def commit_model(
    spark: SparkSession, path: str, name: str, model_uri: str, metrics: dict[str, float], training_date: str
) -> int:
    """Adds the next version of `name` to the registry at `path` and returns it.

    The row is written aside and moved in, as writers into one folder disturb each other. A version belongs to whoever creates its marker, which one of several can; the
    others try the next. A run that breaks off in between leaves its number unused.
    """
    registry = open_registry(spark, path)
    taken = Folder(spark, f"{path}/_versions")
    row = register_model(registry, name, model_uri, metrics, training_date)
    key = hashlib.md5(name.encode()).hexdigest()
    version = row.first().version
    while not taken.create(f"{key}-{version}"):
        version += 1
    aside = f"_staging-{key}-{version}"
    row.withColumn("version", F.lit(version)).coalesce(1).write.parquet(f"{path}/{aside}")
    folder, written = Folder(spark, path), Folder(spark, f"{path}/{aside}")
    (file,) = (n for n in written.names() if n.startswith("part-"))
    folder.move(f"{aside}/{file}", f"{key}-{version}.parquet")
    folder.delete(aside)
    return version


def latest_model(registry: DataFrame) -> DataFrame:
    """The newest version of each model: what the alias 'current' points at."""
    rest = [c for c in registry.columns if c not in ("name", "version")]
    newest = F.max(F.struct("version", *rest)).alias("newest")
    return (
        registry.groupBy("name")
        .agg(newest)
        .select("name", "newest.*")
        .select(*registry.columns, F.lit(MODEL_ALIAS).alias("alias"))
    )


# Fixed value: how a model file carries its date.
MODEL_FILE = r"xgboost_model_(\d{2}_\d{2}_\d{4})\.ubj"


def latest_model_file(files: DataFrame, name: str = "file_name") -> DataFrame:
    """The file with the newest date in its name; the first name among equals.

    Names without a date, or with an impossible one, do not count.
    """
    dated = files.select(
        F.col(name),
        F.try_to_date(F.regexp_extract(name, MODEL_FILE, 1), "dd_MM_yyyy").alias("file_date"),
    ).where(F.col("file_date").isNotNull())
    by_date = dated.groupBy("file_date").agg(F.min(name).alias(name))
    return by_date.agg(F.max(F.struct("file_date", name)).alias("newest")).select(
        F.col("newest")[name].alias(name), F.col("newest.file_date").alias("file_date")
    ).where(F.col(name).isNotNull())


@dataclass(frozen=True)
class RunResult:
    """What a training run leaves behind: 'success' with the metrics of the test rows,
    'error' with the message of what broke it, or 'partial_success' with both if the
    model is saved but not registered."""

    status: str
    model_path: str = ""
    metrics: dict | None = None
    best_params: dict | None = None
    error: str | None = None


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.read().session(spark).load(path)
