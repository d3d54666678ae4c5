"""Every operator run over the shared test tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clickloom.catalog.given import (
    LOOKUP_PRODUCT,
    MEDIAN_ERROR,
    PLANTED_PRICE,
    PLANTED_WEEKDAY,
    STUMPS,
    TRIAL_FEATURES,
    TRIALS,
)
from clickloom.functions.columns import (
    is_valid,
    parsed_timestamp,
    record_hash,
)
from clickloom.operators import encode, lookup, metrics, quality, sessions, upsert
from clickloom.operators.measure import LoadMeasure
from clickloom.operators.median import approximate_median, exact_median
from clickloom.operators.ordered import number_rows
from clickloom.plans import (
    boosting,
    features,
    preparation,
    scoring,
    search,
    training,
    training_run,
    warehouse,
)
from clickloom.schemas import (
    CATEGORICAL_COLUMNS,
    FEATURE_COLUMNS,
    FEATURE_KEY_COLUMNS,
    GOLD_ROW_BOUNDS,
    LABEL,
    LANDED_DOCUMENT,
    LANDED_EVENT,
    RAW_EVENT,
    RAW_ROW_BOUNDS,
)
from clickloom.session import scratch_path, stored
from clickloom.sources import files, notifications
from clickloom.sources import testdata as data
from clickloom.sources.tables import create_table, insert_new
from clickloom.streaming import features as feature_stream
from clickloom.streaming import distinct, landing, rates
from clickloom.streaming import sessions as session_stream
from clickloom.streaming.store import FeatureStore

Query = Callable[[SparkSession, str], DataFrame]

# Columns of a raw event that the derived events can fill.
RAW_COLUMNS = [name for name in warehouse.CONTENT_FIELDS if name != "event_time"]


# -- star schema ------------------------------------------------------------


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.fact_events(data.raw_events(spark, sf))


def vw_user_session_summary(spark: SparkSession, sf: str) -> DataFrame:
    fact = data.session_events(spark, sf).withColumn("event_date", F.to_date("event_timestamp"))
    return warehouse.vw_user_session_summary(
        fact,
        warehouse.dim_user(data.users(spark, sf)),
        warehouse.dim_date(data.base_events(spark, sf)),
        warehouse.dim_product(data.catalog(spark, sf)),
    )


def vw_category_performance(spark: SparkSession, sf: str) -> DataFrame:
    products = data.catalog(spark, sf)
    events = data.raw_events(spark, sf, sessions=False)
    view = warehouse.vw_category_performance(
        events,
        warehouse.dim_category(products),
        warehouse.dim_user(data.users(spark, sf)),
        warehouse.dim_product(products),
    )
    return view.withColumn("avg_price", F.round("avg_price", 6))


def star_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


def dim_user(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.dim_user(data.users(spark, sf))


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    products = warehouse.dim_product(data.catalog(spark, sf))
    return products.withColumn("price", F.col("price").cast("double"))


def dim_category(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.dim_category(data.catalog(spark, sf))


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.dim_date(data.base_events(spark, sf))


def events_in_session(spark: SparkSession, sf: str) -> DataFrame:
    events = data.session_events(spark, sf)
    return events.select("user_session", "event_id", "events_in_session")


def session_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts for events whose session is given: one visit per user and day."""
    visit = F.concat_ws("@", F.col("user_id").cast("string"), F.to_date("event_timestamp"))
    events = data.base_events(spark, sf).select("event_id", visit.alias("user_session"))
    return sessions.with_session_counts(events)


def cart_purchase_events(spark: SparkSession, sf: str) -> DataFrame:
    events = warehouse.cart_purchase_events(data.session_events(spark, sf), data.CART_TYPES)
    return events.select("event_id", "event_type", "user_session", "product_id")


def _indexed_fact(spark: SparkSession, sf: str, types: tuple[str, ...] = ()) -> DataFrame:
    """The fact as it is laid out for lookups, or the events of `types` alone."""
    path = scratch_path(spark, "fact")
    if types:
        warehouse.write_cart_purchases(_fact(spark, sf), path, types)
    else:
        warehouse.write_fact(_fact(spark, sf), path)
    return spark.read.parquet(path)


def _first_user(spark: SparkSession, sf: str) -> int:
    return data.base_events(spark, sf).agg(F.min("user_id")).scalar()


def lookup_user_events(spark: SparkSession, sf: str) -> DataFrame:
    """All events of one user, from the fact laid out for lookups."""
    return _indexed_fact(spark, sf).where(F.col("user_id") == _first_user(spark, sf))


def lookup_session_events(spark: SparkSession, sf: str) -> DataFrame:
    session = F.concat(_first_user(spark, sf).cast("string"), F.lit("-0"))
    return _indexed_fact(spark, sf).where(F.col("user_session") == session)


def lookup_product_events(spark: SparkSession, sf: str) -> DataFrame:
    return _indexed_fact(spark, sf).where(F.col("product_id") == LOOKUP_PRODUCT)


def lookup_category_events(spark: SparkSession, sf: str) -> DataFrame:
    """All events of one product's category."""
    known = data.catalog(spark, sf).where(F.col("product_id") == LOOKUP_PRODUCT)
    category = known.agg(F.min("category_id")).scalar()
    return _indexed_fact(spark, sf).where(F.col("category_id") == category)


def lookup_cart_purchases(spark: SparkSession, sf: str) -> DataFrame:
    """What one product was clicked or bought in, from the events of these types alone."""
    rows = _indexed_fact(spark, sf, data.CART_TYPES).where(F.col("product_id") == LOOKUP_PRODUCT)
    return rows.groupBy("user_session", "product_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Against dimensions that lack the days from 20 January, economy goods and odd users."""
    products = data.catalog(spark, sf)
    events = data.raw_events(spark, sf, sessions=False).withColumn(
        "event_date", F.to_date("event_timestamp")
    )
    known = products.where(~F.col("category_code").startswith("economy."))
    before = F.col("event_timestamp") < F.lit("2024-01-20").cast("timestamp_ntz")
    return quality.fk_violations(
        events,
        {
            "user_id": warehouse.dim_user(data.users(spark, sf).where("user_id % 2 = 0")),
            "product_id": warehouse.dim_product(known),
            "category_id": warehouse.dim_category(known),
            "event_date": warehouse.dim_date(data.base_events(spark, sf).where(before)),
        },
    )


def fk_violations_basic_products(spark: SparkSession, sf: str) -> DataFrame:
    """Events of products that a catalog of the ECONOMY and SMALL lines lacks."""
    products = data.table(spark, sf, "part").where(F.col("p_type").isin("ECONOMY", "SMALL"))
    known = products.select(F.col("p_partkey").alias("product_id"))
    return quality.fk_violations(data.base_events(spark, sf), {"product_id": known})


# -- features ---------------------------------------------------------------


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions are derived once; rows and labels both read them."""
    return features.event_features(_visits(spark, sf), data.PURCHASE_TYPE)


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    return stored(data.raw_events(spark, sf), "visits")


def _features_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Features of a feed that omits one brand's name and the price of economy goods."""
    return _features(spark, sf).withColumns(
        {
            "brand": F.nullif("brand", F.lit("Brand#13")),
            "price": F.when(F.col("category_code_level1") != "economy", F.col("price")),
        }
    )


def event_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).drop("event_timestamp")


def training_projection(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_projection(_features(spark, sf))


def filter_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.filter_features(_features(spark, sf), also=["event_id"])


def fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    filled = features.fill_missing(stored(_features_with_gaps(spark, sf), "gaps"))
    return filled.select("event_id", *FEATURE_COLUMNS, LABEL)


def price_median(spark: SparkSession, sf: str) -> DataFrame:
    events = data.events_per_product(spark, sf)
    return exact_median(events, "price", "median_price", weight="events")


def price_median_approximate(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a price, and whether the sketch's median splits them at most
    MEDIAN_ERROR per cent from the middle."""
    events = data.base_events(spark, sf).join(data.catalog(spark, sf), "product_id")
    middle = approximate_median(events, "price").scalar()
    n, error = F.count("price"), MEDIAN_ERROR / 100
    below, upto = F.count_if(F.col("price") < middle), F.count_if(F.col("price") <= middle)
    near = (below <= (0.5 + error) * n) & (upto >= (0.5 - error) * n)
    return events.agg(n.alias("prices"), near.alias("near_middle"))


def price_range(spark: SparkSession, sf: str) -> DataFrame:
    return quality.price_range(data.events_per_product(spark, sf))


def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Error events carry a month 13, sign-ups a word, the others their time."""
    stamp = F.col("event_timestamp").cast("string")
    raw = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("2024-13"), F.substring(stamp, 8, 40)))
        .when(F.col("event_type") == "signup", F.lit("unknown"))
        .otherwise(stamp)
    )
    events = data.base_events(spark, sf).select("event_id", raw.alias("raw"))
    return events.withColumn("parsed", parsed_timestamp(F.col("raw")))


def _mapping(frame: DataFrame) -> DataFrame:
    """The mapping as it is used: stored, then read back."""
    spark = frame.sparkSession
    path = scratch_path(spark, "mapping")
    encode.save_mapping(encode.category_mapping(frame), path)
    return encode.load_mapping(spark, path)


def _category_frame(spark: SparkSession, sf: str) -> DataFrame:
    """The category columns alone; they need neither sessions nor labels."""
    events = data.raw_events(spark, sf, sessions=False)
    return features.category_columns(events)


def _category_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every combination of values once: they hang on the product and the day, so
    the events are folded to those before they meet the catalog."""
    day = F.date_trunc("day", "event_timestamp").cast("timestamp_ntz").alias("event_timestamp")
    seen = data.base_events(spark, sf).select("product_id", day).distinct()
    events = seen.join(data.catalog(spark, sf), "product_id", "left")
    return features.category_columns(events.withColumn("event_id", F.lit(None)))


def category_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return encode.category_mapping(_category_values(spark, sf))


def encode_categories(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping is learned from events of all but two brands, so some are unseen."""
    frame = _category_frame(spark, sf)
    seen = _category_values(spark, sf).where(~F.col("brand").isin("Brand#7", "Brand#13"))
    encoded = encode.encode_categories(frame, _mapping(seen))
    return encoded.select("event_id", *CATEGORICAL_COLUMNS)


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    part = F.when(features.in_test_set(["event_id"]), "test").otherwise("train")
    return (
        data.base_events(spark, sf).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    )


# -- landing and files ------------------------------------------------------


def parse_notifications(spark: SparkSession, sf: str) -> DataFrame:
    """One object per user and day, named by each of its events. Error events
    send no JSON, sign-ups an empty key, clicks no key."""
    day = F.date_format("event_timestamp", "yyyyMMdd")
    key = F.concat(F.lit("bronze/data/"), day, F.lit("/"), F.col("user_id"), F.lit(".json"))
    message = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), key))
        .when(F.col("event_type") == "signup", F.lit('{"Key": ""}'))
        .when(F.col("event_type") == "click", F.lit('{"Other": 1}'))
        .otherwise(F.concat(F.lit('{"EventName": "put", "Key": "'), key, F.lit('"}')))
    )
    messages = data.base_events(spark, sf).select(F.encode(message, "UTF-8").alias("value"))
    return notifications.notified_paths(messages).distinct()


def _raw_columns(spark: SparkSession, sf: str) -> DataFrame:
    return data.raw_events(spark, sf).select("event_id", *RAW_COLUMNS)


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    events = _raw_columns(spark, sf)
    path = scratch_path(spark, "csv")
    files.write_csv(events, path)
    return files.scan_csv(spark, path, events.schema)


def row_to_json(spark: SparkSession, sf: str) -> DataFrame:
    """Each feature row as a JSON document; fields are read back one by one."""
    names = ["event_id", *LANDED_EVENT.fieldNames()]
    numbered = number_rows(_features(spark, sf).select(*names), ["event_id"])
    documents = files.to_documents(numbered, keep=["row_id"])
    return documents.select("row_id", F.json_tuple("value", *names).alias(*names))


def _landed(spark: SparkSession, sf: str, label: str) -> str:
    path = scratch_path(spark, label)
    files.write_documents(_features(spark, sf).select(*LANDED_DOCUMENT.fieldNames()), path)
    return path


def scan_json(spark: SparkSession, sf: str) -> DataFrame:
    events = files.scan_json(spark, [_landed(spark, sf, "json")], LANDED_DOCUMENT)
    return events.drop("event_id").withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def partitioned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One day of a feed stored by day; the other days' folders are not read."""
    path = scratch_path(spark, "by-day")
    files.write_by_day(data.base_events(spark, sf), path)
    day = files.PartitionedSource(path, {"year": 2024, "month": 1, "day": 7})
    return day.scan(spark)


#: A first load ends before, and a second one begins with.
FIRST_LOAD_END, SECOND_LOAD = "2024-01-21", "2024-01-11"


def landed_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Documents moved to the landing folder by a copy that is stopped and started again:
    it goes on where it was, and each document arrives once."""
    source, target = scratch_path(spark, "outbox"), scratch_path(spark, "inbox")
    cursor = scratch_path(spark, "copy")
    events = _features(spark, sf).select(*LANDED_DOCUMENT.fieldNames())
    early = F.coalesce(F.col("event_timestamp") < SECOND_LOAD, F.lit(False))
    for part in (events.where(early), events.where(~early)):
        files.to_documents(part).write.mode("append").text(source)
        landing.copy_to_landing(
            spark, source, target, cursor, max_files=4, drain=True
        ).awaitTermination()
    landed = files.scan_json(spark, target, LANDED_DOCUMENT)
    return landed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def record_table(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table of records, made where it is absent and loaded twice: the days to
    20 January, and then those from the 11th on, sent under another name. A record
    stays as it was first loaded."""
    place = scratch_path(spark, "record-table")
    name = f"records_{place[-32:]}"
    time = F.date_format("event_timestamp", files.TIMESTAMP_TEXT)
    events = stored(data.raw_events(spark, sf).withColumn("event_time", time), "raw")
    first = events.where(F.col("event_timestamp") < FIRST_LOAD_END)
    second = events.where(F.col("event_timestamp") >= SECOND_LOAD)
    for sent, sender in ((first, "first"), (second, "second")):
        create_table(spark, name, RAW_EVENT, ["event_type"], place)
        records = warehouse.raw_records(sent, sender)
        insert_new(
            spark, name, records, ["record_hash"], ["processed_date"], ["event_type"], ["user_session"]
        )
    spark.sql(f"DROP TABLE {name}")  # the files stay until the application ends
    return spark.read.schema(RAW_EVENT).parquet(place).drop("processed_date")


def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """A table of the days to 20 January takes in a feed that starts on the 11th
    and sends every event twice, the second time restated."""
    events = data.table(spark, sf, "events").select("event_id", "event_type", "value", "ts")
    stored = events.where(F.col("ts") < FIRST_LOAD_END).drop("ts")
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    sent = events.where(F.col("ts") >= SECOND_LOAD).drop("ts").withColumn("value", value)
    first = sent.withColumn("sending", F.lit(1))
    second = sent.withColumns({"sending": F.lit(2), "event_type": F.lit("restated")})
    return upsert.insert_ignore(stored, first.unionByName(second), ["event_id"], ["sending"])


# -- online features --------------------------------------------------------


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return features.latest_features(_visits(spark, sf), purchase_type=data.PURCHASE_TYPE)


def online_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.as_online(_latest(spark, sf))


def _streamed_table(spark: SparkSession, sf: str, lost_commit: bool = False) -> str:
    """Landed JSON files streamed into the keyed table in several batches.

    Beside the events, each sign-up sends a document without a user and each error
    one that breaks off. With `lost_commit` the stream breaks off after its last batch is
    written and before it is committed, and the stream that follows writes the batch again.
    """
    landed = _landed(spark, sf, "landed")
    events = data.base_events(spark, sf)
    keyless = F.to_json(F.struct("event_id", "product_id"))
    broken = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(", broken"))
    bad = events.where(F.col("event_type").isin("signup", "error"))
    bad = bad.select(F.when(F.col("event_type") == "signup", keyless).otherwise(broken))
    bad.write.mode("append").text(landed)
    table, cursor = scratch_path(spark, "feature-table"), scratch_path(spark, "feature-stream")
    written: list[int] = []
    for _ in range(2 if lost_commit else 1):
        feature_stream.stream_features(
            landing.landed_events(spark, landed, max_files=4),
            table,
            cursor,
            publish=lambda _, batch_id: written.append(batch_id),
            drain=True,
        ).awaitTermination()
        if lost_commit and len(written) == len(set(written)):
            files.Folder(spark, f"{cursor}/commits").delete(str(max(written)))
    if lost_commit and len(written) == len(set(written)):
        raise RuntimeError("no batch was written again")
    return table


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream set aside: rows without a key, by event, and broken documents."""
    table = _streamed_table(spark, sf)
    aside = feature_stream.read_quarantine(spark, feature_stream.quarantine_of(table))
    corrupt = F.col(files.CORRUPT)
    return aside.select(
        F.when(corrupt.isNull(), "no key").otherwise("malformed").alias("reason"),
        F.when(corrupt.isNull(), F.col("event_id")).alias("event_id"),
        corrupt.alias("document"),
    )


def stream_online_features(spark: SparkSession, sf: str) -> DataFrame:
    return _online(feature_stream.read_features(spark, _streamed_table(spark, sf)))


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the feature table, and rows set aside, after a batch was written twice."""
    table = _streamed_table(spark, sf, lost_commit=True)
    online = _online(feature_stream.read_features(spark, table))
    aside = feature_stream.read_quarantine(spark, feature_stream.quarantine_of(table))
    return online.select(F.lit("feature").alias("kind"), F.col("feature_key").alias("row")).unionByName(
        aside.select(
            F.lit("set aside").alias("kind"),
            F.coalesce(F.col(files.CORRUPT), F.col("event_id").cast("string")).alias("row"),
        )
    )


def _online(stored: DataFrame) -> DataFrame:
    stamp = F.col("event_timestamp").cast("timestamp_ntz")
    return features.as_online(stored.withColumn("event_timestamp", stamp))


def numeric_default(spark: SparkSession, sf: str) -> DataFrame:
    online = features.as_online(_latest(spark, sf))
    return lookup.numeric_features(online).select("feature_key", *FEATURE_COLUMNS)


# -- quality ----------------------------------------------------------------


def _hashed(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their content hash; sign-ups arrive without a product."""
    product = F.when(F.col("event_type") != "signup", F.col("product_id"))
    events = data.base_events(spark, sf).withColumn("product_id", product)
    return events.withColumn(
        "record_hash", record_hash(["event_timestamp", "event_type", "user_id", "product_id"])
    )


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the table of records holds them, without the time of loading."""
    time = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss")
    events = data.raw_events(spark, sf).withColumn("event_time", time)
    return warehouse.raw_records(events, "shop").drop("processed_date")


def record_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return _hashed(spark, sf).select("event_id", "record_hash")


def validate_events(spark: SparkSession, sf: str) -> DataFrame:
    """The non-null rule of a raw event; sign-ups carry no product."""
    product = F.when(F.col("event_type") != "signup", F.col("product_id"))
    events = data.raw_events(spark, sf).withColumn("product_id", product)
    required = [f.name for f in RAW_EVENT.fields if not f.nullable and f.name in RAW_COLUMNS]
    return events.select("event_id", is_valid(required).alias("valid"))


def row_count_check(spark: SparkSession, sf: str) -> DataFrame:
    raw = quality.row_count_check(data.base_events(spark, sf), "raw_data_suite", RAW_ROW_BOUNDS)
    facts = data.raw_events(spark, sf)
    gold = quality.row_count_check(facts, "gold_layer_suite", GOLD_ROW_BOUNDS)
    return raw.unionByName(gold)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups lack a product; errors of one user and day count as one record."""
    is_error = F.col("event_type") == "error"
    stamp = F.when(is_error, F.date_trunc("day", "event_timestamp").cast("timestamp_ntz"))
    events = data.base_events(spark, sf).select(
        F.coalesce(stamp, F.col("event_timestamp")).alias("event_timestamp"),
        "event_type",
        "user_id",
        F.when(F.col("event_type") == "signup", None)
        .when(is_error, F.lit(0))
        .otherwise(F.col("product_id"))
        .alias("product_id"),
    )
    fields = events.columns
    return events.select(is_valid(fields).alias("valid"), record_hash(fields).alias("record_hash"))


def load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.load_metrics(_records(spark, sf))


def load_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of a load of the records into a table of their own, by what the load
    measured as it ran, its time included."""
    path = scratch_path(spark, "records")
    measure = LoadMeasure(spark, F.col("valid"))
    with measure:
        records = measure.incoming(_records(spark, sf))
        added = upsert.first_per_key(records, ["record_hash"], ["valid"])
        measure.written(added).write.parquet(path)
    alerts = quality.load_alerts(measure.metrics())
    fired = F.coalesce(F.col("fired").cast("string"), F.lit("not evaluated"))
    return alerts.withColumn("fired", fired)


# -- scoring ----------------------------------------------------------------


def _scoring_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Requests and features, from events that are read once.

    A user's day is one request for all products they met in it. Features exist
    for what was viewed, clicked or bought; other keys are missing. Economy goods
    come without a price.
    """
    events = _visits(spark, sf)
    request = F.concat_ws("@", F.col("user_id").cast("string"), F.to_date("event_timestamp"))
    requests = events.select(request.alias("request_id"), *FEATURE_KEY_COLUMNS).distinct()
    shop = events.where(F.col("event_type").isin("view", "click", "purchase"))
    newest = features.latest_features(shop, purchase_type=data.PURCHASE_TYPE)
    price = F.when(F.col("category_code_level1") != "economy", F.col("price"))
    known = newest.select(*FEATURE_KEY_COLUMNS, *FEATURE_COLUMNS).withColumn("price", price)
    return requests, stored(known, "known")


def feature_lookup(spark: SparkSession, sf: str) -> DataFrame:
    requests, known = _scoring_tables(spark, sf)
    met = lookup.looked_up(requests, known.select(*FEATURE_KEY_COLUMNS))
    return lookup.answered(stored(met, "looked-up"))


#: Batches that the store of the lookup is written in; one of them is sent twice.
STORE_BATCHES, SENT_TWICE = 6, 2


def store_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Requests looked up in the bucketed store, whose rows came in batches in no order
    of time; what is found must be the newest row of the key."""
    events = _visits(spark, sf)
    shop = events.where(F.col("event_type").isin("view", "click", "purchase"))
    rows = stored(features.event_features(shop, data.PURCHASE_TYPE), "shop")
    store = FeatureStore(spark, scratch_path(spark, "store"), buckets=8)
    batch = F.pmod(F.xxhash64("event_id"), F.lit(STORE_BATCHES))
    for number in [*range(STORE_BATCHES), SENT_TWICE]:
        store.write(rows.where(batch == number), number)
    request = F.concat_ws("@", F.col("user_id").cast("string"), F.to_date("event_timestamp"))
    requests = events.select(request.alias("request_id"), *FEATURE_KEY_COLUMNS).distinct()
    return lookup.answered(stored(store.lookup(requests), "looked-up")).select(
        "request_id", *FEATURE_KEY_COLUMNS, "found", "batch_ok", "event_id", "event_weekday", "price"
    )


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Requests scored with prepared features: encoded categories, median price."""
    requests, known = _scoring_tables(spark, sf)
    folder = scratch_path(spark, "preparation")
    preparation.learn(known).save(folder)
    weights = scoring.LINEAR_WEIGHTS | scoring.CATEGORY_WEIGHTS
    score = scoring.linear_score(weights)
    inputs = preparation.load(spark, folder).apply(known)
    return scoring.batch_score(requests, inputs, lambda rows: rows.withColumn("prediction", score))


def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).withColumn("prediction", F.round("prediction", 9))


def scoring_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.status_counts(_scored(spark, sf))


def request_rate_5m(spark: SparkSession, sf: str) -> DataFrame:
    events = data.base_events(spark, sf)
    return rates.request_rate(events, "event_timestamp", "event_type")


def stream_request_rate_5m(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream, counted as they arrive."""
    stamp = F.col("ts").cast("timestamp")
    events = data.stream(spark, sf, "events").select(stamp.alias("event_timestamp"), "event_type")
    path = scratch_path(spark, "rates")
    rates.count_stream(
        events, "event_timestamp", "event_type", "1 hour", path, scratch_path(spark, "rate-stream")
    ).awaitTermination()
    rows = rates.read_rates(spark, path, "event_type")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


#: More than the tables' span, as their rows come in no order of time.
LATENESS = "60 days"


def _feed(spark: SparkSession, events: DataFrame, files: int) -> tuple[str, DataFrame]:
    """`events` as files that arrive, and the stream of them, a few at a time."""
    path = scratch_path(spark, "feed")
    stamped = events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    stamped.repartition(files).write.parquet(path)
    stream = spark.readStream.schema(stamped.schema).option("maxFilesPerTrigger", 3).parquet(path)
    return path, stream


def stream_distinct_events(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that sends every event twice and purchases three times, in any order."""
    fields = ["event_timestamp", "event_type", "user_id", "product_id"]
    events = data.base_events(spark, sf)
    again = events.unionByName(events.where(F.col("event_type") == data.PURCHASE_TYPE))
    _, stream = _feed(spark, events.unionByName(again).select(fields), 8)
    path = scratch_path(spark, "distinct")
    distinct.write_distinct(
        stream, path, scratch_path(spark, "distinct-stream"), LATENESS, fields, drain=True
    ).awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(path)
    return rows.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of the events as they arrive; a last event closes those still open."""
    events = data.base_events(spark, sf).select("user_id", "event_timestamp")
    feed, stream = _feed(spark, events, 8)
    path, cursor = scratch_path(spark, "sessions"), scratch_path(spark, "session-stream")
    session_stream.write_sessions(stream, path, cursor, LATENESS, drain=True).awaitTermination()
    sent = spark.read.schema(stream.schema).parquet(feed)
    session_stream.closing_event(spark, sent, LATENESS).write.mode("append").parquet(feed)
    session_stream.write_sessions(stream, path, cursor, LATENESS, drain=True).awaitTermination()
    schema = "user_id long, event_count long, session_start timestamp, session_end timestamp"
    ends = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    return spark.read.schema(schema).parquet(path).withColumns(ends)


# -- model ------------------------------------------------------------------


def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = _features(spark, sf).withColumn("score", scoring.linear_score())
    measured = metrics.classification_metrics(scored, LABEL, "score")
    return measured.withColumn("value", F.round("value", 8))


def metric_history(spark: SparkSession, sf: str) -> DataFrame:
    """All metrics of the train and test rows after each round of a fixed ensemble."""
    part = F.when(features.in_test_set(["event_id"]), "test").otherwise("train")
    rows = _features(spark, sf).withColumn("part", part)
    trees = [boosting.stump(*split[:4]) for split in STUMPS]
    scores = boosting.staged_scores(rows, trees, [s[4] for s in STUMPS], ["part", LABEL])
    measured = boosting.round_metrics(scores, LABEL)
    return measured.select("part", "metric", "step", F.round("value", 8).alias("value"))


def _search(spark: SparkSession, sf: str) -> DataFrame:
    """The trial table of a search over the given points: trees of one split, grown
    together on all rows."""
    points = [
        search.Trial(1, rate, weight, gamma=gain, features=names) for names, rate, weight, gain in TRIALS
    ]
    cells, _ = search.binned(_features(spark, sf), TRIAL_FEATURES, LABEL, ["event_id"], bins=256)
    errors = search.grown(cells, TRIAL_FEATURES, points)
    rows = [
        (n, ",".join(names), rate, weight, gain, error)
        for n, ((names, rate, weight, gain), error) in enumerate(zip(TRIALS, errors))
    ]
    columns = "trial_id int, features string, learning_rate double, min_child_weight double, gamma double"
    path = scratch_path(spark, "trials")
    spark.createDataFrame(rows, f"{columns}, train_rmse double").coalesce(1).write.parquet(path)
    return spark.read.parquet(path).withColumn("train_rmse", F.round("train_rmse", 9))


def search_trials(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf)


def best_trial(spark: SparkSession, sf: str) -> DataFrame:
    """The best row of the table that the search wrote."""
    return training.best_trial(_search(spark, sf))


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    """A model per event type, retrained each day it has events."""
    return (
        data.base_events(spark, sf)
        .groupBy("event_type", F.to_date("event_timestamp").alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.concat_ws("_", F.lit(training.MODEL_NAME), "event_type").alias("name"),
            (F.datediff("day", F.lit("2024-01-01")) + 1).alias("version"),
            F.concat_ws("/", F.lit("models:"), "event_type", F.date_format("day", "yyyy-MM-dd"))
            .alias("model_uri"),
            F.date_format("day", "yyyy-MM-dd").alias("training_date"),
            F.to_json(F.struct("rows")).alias("metrics"),
        )
    )


def latest_model(spark: SparkSession, sf: str) -> DataFrame:
    return training.latest_model(_registry(spark, sf))


#: Runs that register at the same time.
REGISTERING = 3


def model_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A registry that several runs add a model of each event type to at once: every
    registration gets a version of its own, and the newest carries the alias."""
    counts = data.base_events(spark, sf).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users")
    )
    path = scratch_path(spark, "registry")
    training.open_registry(spark, path)

    def register(kind: Row) -> int:
        metrics = {"rows": kind.rows, "users": kind.users}
        return training.commit_model(
            spark, path, kind.event_type, f"models:/{kind.event_type}", metrics, "2024-02-01"
        )

    kinds = [kind for kind in counts.collect() for _ in range(REGISTERING)]  # one row per type
    with ThreadPoolExecutor(REGISTERING) as pool:
        list(pool.map(register, kinds))
    registry = stored(training.open_registry(spark, path), "versions")
    current = training.latest_model(registry).select("name", "version", "alias")
    return registry.join(current, ["name", "version"], "left").drop("description")


def latest_model_file(spark: SparkSession, sf: str) -> DataFrame:
    """A file per day with purchases, one without a date per day with errors."""
    events = data.base_events(spark, sf)
    dated = F.concat(
        F.lit("xgboost_model_"), F.date_format("event_timestamp", "dd_MM_yyyy"), F.lit(".ubj")
    )
    name = F.when(F.col("event_type") == "purchase", dated).otherwise(
        F.concat(F.lit("xgboost_model_"), "event_type", F.lit(".ubj"))
    )
    return training.latest_model_file(events.select(name.alias("file_name")).distinct())


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared features by part, from a stored feature table."""
    table = stored(_features(spark, sf), "features")
    return training_run.prepared_parts(table, ["event_id"])[1]


#: Standard errors that are put down to chance when a model is judged.
CHANCE = 3


def model_fits(part: Column, label: Column, p: Column) -> Column:
    """Whether a part's squared error exceeds that of its own base rate by no more than
    CHANCE standard errors, which shrink with the part. On the training rows the model
    must also say more than any constant: the label has to rise with the prediction, by
    more than CHANCE standard errors."""
    squared = (label - p) * (label - p)
    rate, root = F.avg(label), F.sqrt(F.count(squared))
    slack = CHANCE * F.coalesce(F.stddev_samp(squared), F.lit(0.0)) / root
    near = F.avg(squared) <= rate * (1 - rate) + slack
    label = label.cast("double")
    rises = F.covar_pop(label, p) > CHANCE * F.stddev_pop(label) * F.stddev_pop(p) / root
    return near & ((F.first(part) != "train") | rises)


def train_purchase_model(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees learned on one part of the events, stopped by another, measured
    on a third: rows and purchases of each part, the squared error of its base rate, and
    whether the model fits it, that is at least halves this error. What is bought hangs
    on weekday and price here, as the tables' own purchases hang on nothing."""
    weekend, dear = F.col("event_weekday") >= PLANTED_WEEKDAY, F.col("price") > PLANTED_PRICE
    planted = _features(spark, sf).withColumn(LABEL, (weekend != dear).cast("int"))
    table = stored(planted, "features")
    rows = training_run.prepared_parts(table, ["event_id"])[1]
    model = training.train(
        rows.where("part <> 'test'"), {"max_depth": 3, "num_boost_round": 5}, validation="held_out"
    )
    label, p = F.col(LABEL), F.col("p")
    base = F.avg(label) * (1 - F.avg(label))
    halved = 2 * F.avg((label - p) * (label - p)) < base
    return training.score(model, rows, "p").groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(LABEL).cast("long").alias("purchases"),
        F.round(base, 8).alias("base_error"),
        (halved & model_fits(F.col("part"), label, p)).alias("fits"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        vw_user_session_summary,
        vw_category_performance,
        star_fact,
        dim_user,
        dim_product,
        dim_category,
        dim_date,
        events_in_session,
        session_event_counts,
        cart_purchase_events,
        lookup_user_events,
        lookup_session_events,
        lookup_product_events,
        lookup_category_events,
        lookup_cart_purchases,
        fk_violations,
        fk_violations_basic_products,
        event_features,
        training_projection,
        filter_features,
        fill_missing,
        price_median,
        price_median_approximate,
        price_range,
        parse_timestamps,
        category_mapping,
        encode_categories,
        train_test_split,
        parse_notifications,
        scan_csv,
        row_to_json,
        scan_json,
        partitioned_scan,
        landed_copy,
        record_table,
        insert_ignore,
        online_features,
        stream_online_features,
        stream_quarantine,
        stream_replay,
        numeric_default,
        raw_records,
        validate_events,
        row_count_check,
        load_metrics,
        load_alerts,
        feature_lookup,
        store_lookup,
        batch_score,
        scoring_status_counts,
        request_rate_5m,
        stream_request_rate_5m,
        stream_distinct_events,
        stream_sessions,
        classification_metrics,
        metric_history,
        search_trials,
        best_trial,
        latest_model,
        model_versions,
        latest_model_file,
        train_purchase_model,
    ]
}
QUERIES["record_hash"] = record_hashes
