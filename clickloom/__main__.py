"""The jobs from the command line: spark-submit or `python -m clickloom <job> ...`."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clickloom.functions.columns import category_id
from clickloom.operators import quality
from clickloom.operators.measure import LoadMeasure, append_to_log, latest_load
from clickloom.plans import preparation, scoring, training, warehouse
from clickloom.plans.training_run import train_and_register
from clickloom.schemas import FEATURE_KEY_COLUMNS, GOLD_ROW_BOUNDS, LANDED_DOCUMENT, RAW_EVENT
from clickloom.session import build_session, object_store_options
from clickloom.sources.files import scan_csv, typed, write_documents
from clickloom.sources.notifications import kafka_notifications
from clickloom.sources.tables import create_table, insert_new
from clickloom.streaming import features as feature_stream
from clickloom.streaming.landing import copy_to_landing, landed_events

RAW_CSV = (
    "event_time string, event_type string, product_id long, category_id long, "
    "category_code string, brand string, price double, user_id long, user_session string"
)
REQUESTS = "request_id string, user_id long, product_id long, user_session string"


def documents(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = spark.read.option("header", True).csv(args.source)
    write_documents(typed(rows, LANDED_DOCUMENT), args.target)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    copy_to_landing(
        spark, args.source, args.target, args.checkpoint, args.max_files, args.drain
    ).awaitTermination()


def features(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.kafka:
        messages = kafka_notifications(
            spark, args.kafka, args.source, fail_on_loss=not args.skip_lost
        )
        write = feature_stream.feature_batch_writer(args.target, args.quarantine)
        aside = args.quarantine or feature_stream.quarantine_of(args.target)
        load = feature_stream.notified_batch_writer(write, f"{aside}_absent")
        query = (
            messages.writeStream.foreachBatch(load)
            .option("checkpointLocation", args.checkpoint)
            .trigger(processingTime=feature_stream.TRIGGER)
            .start()
        )
    else:
        query = feature_stream.stream_features(
            landed_events(spark, args.source, args.max_files),
            args.target, args.checkpoint, args.quarantine, drain=args.drain,
        )
    query.awaitTermination()


def star(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = scan_csv(spark, args.source, RAW_CSV)
    text = F.regexp_replace("event_time", " UTC$", "")
    events = raw.withColumns(
        {
            "event_timestamp": text.try_cast("timestamp_ntz"),
            "event_id": F.col("event_time"),
            "category_id": F.coalesce("category_id", category_id(F.col("category_code"))),
        }
    )
    warehouse.write_star_schema(events, args.target)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw events into the table of records; records that are there stay as they are."""
    raw = scan_csv(spark, args.source, RAW_CSV)
    raw = raw.withColumn("category_id", F.coalesce("category_id", category_id(F.col("category_code"))))
    records = warehouse.raw_records(raw, args.pipeline)
    create_table(spark, args.target, RAW_EVENT, ["event_type"], args.location)
    measure = LoadMeasure(spark, F.col("valid"))
    insert_new(
        spark, args.target, records, ["record_hash"], ["processed_date"], ["event_type"], ["user_session"],
        measure,
    )
    metrics = measure.metrics()
    if args.log:
        append_to_log(metrics, args.log)
    for alert in quality.load_alerts(metrics).where("fired").collect():
        print(f"alert: {alert.rule}")


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    """Checks a star schema: row counts and foreign keys, of a table of records
    volumes and alerts, and the alerts of the load that was logged last. One parquet folder
    for each below the target."""
    read = lambda name: spark.read.parquet(f"{args.source}/{name}")
    fact = read("fact_events")
    keys = {"user_id": "dim_user", "product_id": "dim_product", "category_id": "dim_category"}
    dimensions = {key: read(name) for key, name in {**keys, "event_date": "dim_date"}.items()}
    results = {
        "row_counts": quality.row_count_check(fact, "gold_layer_suite", GOLD_ROW_BOUNDS),
        "foreign_keys": quality.fk_violations(fact, dimensions),
        "prices": quality.price_range(dimensions["product_id"]),
    }
    if args.records:
        records = spark.table(args.records).withColumn("valid", F.col("valid").cast("boolean"))
        results["metrics"] = quality.load_metrics(records)
        results["alerts"] = quality.load_alerts(results["metrics"])
    if args.log:
        results["load"] = latest_load(spark, args.log)
        results["load_alerts"] = quality.load_alerts(results["load"])
    for name, result in results.items():
        result.write.mode("overwrite").parquet(f"{args.target}/{name}")


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    table = feature_stream.read_features(spark, args.source)
    result = train_and_register(
        table, args.registry, args.target, args.run_id, date.today().isoformat(),
        args.trials, args.rounds, null_policy=args.null_policy,
    )
    print(result)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    registry = training.open_registry(spark, args.registry)
    current = training.latest_model(registry.where(F.col("name") == training.MODEL_NAME)).first()
    if current is None:
        raise SystemExit(f"no model is registered at {args.registry}")
    model = training.load_model(spark, current.model_uri)
    learned = preparation.load(spark, current.model_uri.removesuffix("/model"))
    inputs = learned.apply(feature_stream.read_features(spark, args.features))
    requests = spark.read.schema(REQUESTS).json(args.source)
    results = scoring.batch_score(
        requests.select("request_id", *FEATURE_KEY_COLUMNS), inputs, scoring.model_scorer(model)
    )
    results.write.parquet(args.target)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="clickloom")
    jobs = parser.add_subparsers(required=True)

    def job(run, *options: tuple[str, dict]) -> None:
        command = jobs.add_parser(run.__name__)
        command.add_argument("source")
        command.add_argument("target")
        for name, settings in options:
            command.add_argument(name, **settings)
        command.set_defaults(run=run)

    checkpoint = ("--checkpoint", {"required": True})
    drain = ("--drain", {"action": "store_true"})
    registry = ("--registry", {"required": True})
    job(documents)
    job(land, checkpoint, drain, ("--max-files", {"type": int, "default": 1}))
    job(
        features, checkpoint, drain, ("--max-files", {"type": int, "default": 1000}),
        ("--quarantine", {}), ("--kafka", {"help": "servers; source is then the topic"}),
        ("--skip-lost", {"action": "store_true"}),
    )
    job(star)
    log = ("--log", {"help": "folder of the loads' metrics"})
    job(load, ("--pipeline", {"default": "batch"}), ("--location", {}), log)
    job(check, ("--records", {"help": "table of raw records"}), log)
    job(
        train, registry, ("--run-id", {"required": True}),
        ("--trials", {"type": int, "default": training.NUM_TRIALS}),
        ("--rounds", {"type": int, "default": 1}),
        ("--null-policy", {"choices": preparation.NULL_POLICIES, "default": "unseen"}),
    )
    job(score, registry, ("--features", {"required": True}))
    parser.add_argument("--object-store", help="endpoint of an S3-compatible store")
    args = parser.parse_args(argv)
    store = object_store_options(args.object_store) if args.object_store else {}
    args.run(build_session("clickloom", extra=store), args)


if __name__ == "__main__":
    main()
