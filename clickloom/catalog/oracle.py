"""The same results in DuckDB SQL, straight from the test tables.

The statements are written on their own terms (sessions by an ordered window,
labels and latest rows by windows, the rate by a range condition), so agreement
checks the Spark side's method and not only its wiring.
"""

from __future__ import annotations

from clickloom.catalog.given import (
    LOOKUP_PRODUCT,
    PLANTED_PRICE,
    PLANTED_WEEKDAY,
    STUMPS,
    TRIAL_FEATURES,
    TRIALS,
)

# Building blocks, in the order a statement may need them.
_BLOCKS = {
    "ev": """
        SELECT event_id, event_type, user_id, ts,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id
        FROM events""",
    "gaps": """
        SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS brk
        FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "numbered": """
        SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id
                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n
        FROM gaps""",
    "sess": """
        SELECT event_id, event_type, user_id, product_id, ts,
               user_id || '-' || n AS user_session,
               count(*) OVER (PARTITION BY user_id, n) AS events_in_session
        FROM numbered""",
    "products": """
        SELECT *, CAST('0x' || substr(md5(category_code), 1, 15) AS BIGINT) AS category_id
        FROM (SELECT p_partkey AS product_id, p_brand AS brand, p_retailprice AS price,
                     lower(p_type) || '.' || replace(p_name, ' ', '.') AS category_code
              FROM part)""",
    "raw": """
        SELECT s.*, p.brand, p.price, p.category_code, p.category_id
        FROM sess s LEFT JOIN products p USING (product_id)""",
    "feat": """
        SELECT event_id, ts, user_id, product_id, user_session, price, brand,
               split_part(category_code, '.', 1) AS category_code_level1,
               substr(category_code, strpos(category_code, '.') + 1) AS category_code_level2,
               isodow(ts) - 1 AS event_weekday,
               events_in_session AS activity_count,
               max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY user_session, product_id) AS is_purchased
        FROM raw""",
    "online": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, product_id, user_session
                                         ORDER BY ts DESC, event_id DESC) AS rn
            FROM feat) WHERE rn = 1""",
    "shop_raw": """
        SELECT * FROM raw WHERE event_type IN ('view', 'click', 'purchase')""",
    "shop": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT event_id, user_id, product_id, user_session, price,
                   events_in_session AS activity_count, isodow(ts) - 1 AS event_weekday, brand,
                   split_part(category_code, '.', 1) AS category_code_level1,
                   substr(category_code, strpos(category_code, '.') + 1) AS category_code_level2,
                   row_number() OVER (PARTITION BY user_id, product_id, user_session
                                      ORDER BY ts DESC, event_id DESC) AS rn
            FROM shop_raw) WHERE rn = 1""",
    "ready": """
        SELECT user_id, product_id, user_session, activity_count,
               CASE WHEN category_code_level1 <> 'economy' THEN price
                    ELSE (SELECT median(price) FROM shop WHERE category_code_level1 <> 'economy')
               END AS price,
               dense_rank() OVER (ORDER BY event_weekday) - 1 AS event_weekday,
               dense_rank() OVER (ORDER BY brand) - 1 AS brand_no,
               dense_rank() OVER (ORDER BY category_code_level1) - 1 AS level1_no,
               dense_rank() OVER (ORDER BY category_code_level2) - 1 AS level2_no
        FROM shop""",
    "requests": """
        SELECT DISTINCT user_id || '@' || CAST(ts AS DATE) AS request_id,
               user_id, product_id, user_session
        FROM sess""",
    "answers": """
        SELECT r.*, s.user_id IS NOT NULL AS found,
               bool_and(s.user_id IS NOT NULL) OVER (PARTITION BY request_id) AS batch_ok,
               0.001::DOUBLE * s.price + 0.1::DOUBLE * s.event_weekday
                   + 0.05::DOUBLE * s.activity_count + 0.01::DOUBLE * s.brand_no
                   + 0.02::DOUBLE * s.level1_no + 0.0001::DOUBLE * s.level2_no AS z
        FROM requests r LEFT JOIN ready s
          ON r.user_id = s.user_id AND r.product_id = s.product_id
         AND r.user_session = s.user_session""",
    "loaded": """
        SELECT CASE WHEN event_type = 'error' THEN date_trunc('day', ts) ELSE ts END AS ts,
               event_type, user_id,
               CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 0 ELSE product_id END
                   AS product_id
        FROM ev""",
    "volumes": """
        SELECT count(*) AS total_records, count(product_id) AS valid_records,
               count(*) - count(product_id) AS invalid_records,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM loaded))
                   AS duplicate_records
        FROM loaded""",
    "registry": """
        SELECT 'purchase_prediction_model_' || event_type AS name,
               date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS version,
               'models:/' || event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS model_uri,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS training_date,
               '{"rows":' || count(*) || '}' AS metrics
        FROM ev GROUP BY event_type, CAST(ts AS DATE)""",
}

_NEEDS = {
    "gaps": ["ev"],
    "numbered": ["gaps"],
    "sess": ["numbered"],
    "raw": ["sess", "products"],
    "feat": ["raw"],
    "online": ["feat"],
    "shop_raw": ["raw"],
    "shop": ["shop_raw"],
    "requests": ["sess"],
    "ready": ["shop"],
    "answers": ["requests", "ready"],
    "loaded": ["ev"],
    "volumes": ["loaded"],
    "registry": ["ev"],
}


def _with(*blocks: str) -> str:
    wanted: set[str] = set()

    def want(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for needed in _NEEDS.get(name, []):
                want(needed)

    for name in blocks:
        want(name)
    parts = [f"{name} AS ({sql})" for name, sql in _BLOCKS.items() if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n"


# A content text: length and value of each field, '-' for null.
def _content(fields: list[tuple[str, str]]) -> str:
    parts = [
        f"coalesce(length({text}) || ':' || {text}, '-')"
        for text in (f"CAST({sql} AS VARCHAR)" for sql, _ in fields)
    ]
    return " || '|' || ".join(parts)


_PRODUCT_UNLESS_SIGNUP = "CASE WHEN event_type <> 'signup' THEN product_id END"
_FACT_KEY = _content(
    [
        (name, "")
        for name in (
            "event_id", "ts", "event_type", "user_id", "product_id",
            "user_session", "category_id", "price",
        )
    ]
)
_RECORD = [
    "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price",
    "user_id", "user_session",
]
_RECORD_HASH = f'sha256({_content([(name, "") for name in _RECORD])})'
_RECORD_VALID = """CAST(product_id IS NOT NULL AND category_id IS NOT NULL AND price IS NOT NULL
                    AND user_session IS NOT NULL AS VARCHAR)"""
_HASH = _content(
    [("ts", ""), ("event_type", ""), ("user_id", ""), (_PRODUCT_UNLESS_SIGNUP, "")]
)

_NUMERIC = """brand_n AS brand, price, CAST(event_weekday AS DOUBLE) AS event_weekday,
       0.0::DOUBLE AS category_code_level1, 0.0::DOUBLE AS category_code_level2,
       CAST(activity_count AS DOUBLE) AS activity_count"""

_ONLINE = """
    SELECT 'user:' || user_id || ':product:' || product_id || ':session:' || user_session
               AS feature_key,
           brand, CAST(price AS VARCHAR) AS price, CAST(event_weekday AS VARCHAR) AS event_weekday,
           category_code_level1, category_code_level2,
           CAST(activity_count AS VARCHAR) AS activity_count,
           CAST(is_purchased AS VARCHAR) AS is_purchased, user_session,
           CAST({ts} AS VARCHAR) AS event_timestamp
    FROM online"""

# Each trial grows one tree of one split from a margin of 0: gradients are 0.5 - y,
# weights 0.25 a row.
_TRIAL_ROWS = ", ".join(
    f"({i}, '{','.join(names)}', {names.index(f)}, '{f}', {rate}::DOUBLE, {weight}::DOUBLE, {gain}::DOUBLE)"
    for i, (names, rate, weight, gain) in enumerate(TRIALS)
    for f in names
)
_VALUES = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, is_purchased AS y FROM feat"
    for f in TRIAL_FEATURES
)
_SEARCH = _with("feat") + f"""
        , point(trial_id, features, no, feature, rate, weight, least_gain) AS (VALUES {_TRIAL_ROWS}),
        bins AS (SELECT feature, v, count(*) AS n, sum(y) AS s FROM ({_VALUES}) GROUP BY feature, v),
        cuts AS (
            SELECT feature, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
                   sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
            FROM bins WINDOW w AS (PARTITION BY feature ORDER BY v)),
        sums AS (
            SELECT *, 0.5::DOUBLE * nl - sl AS gl, 0.25::DOUBLE * nl AS hl,
                   0.5::DOUBLE * (n - nl) - (s - sl) AS gr, 0.25::DOUBLE * (n - nl) AS hr,
                   0.5::DOUBLE * n - s AS g, 0.25::DOUBLE * n AS h
            FROM cuts),
        gains AS (
            SELECT *, (gl * gl / (hl + 1) + gr * gr / (hr + 1) - g * g / (h + 1)) / 2 AS gain FROM sums),
        ranked AS (
            SELECT *, nl < n AND hl >= weight AND hr >= weight AND gain > least_gain AS splits,
                   row_number() OVER (PARTITION BY trial_id ORDER BY nl < n AND hl >= weight
                       AND hr >= weight AND gain > least_gain DESC, gain DESC, no, v) AS place
            FROM point JOIN gains USING (feature)),
        leaves AS (
            SELECT *, CASE WHEN splits THEN -gl / (hl + 1) * rate ELSE -g / (h + 1) * rate END AS zl,
                   CASE WHEN splits THEN -gr / (hr + 1) * rate ELSE -g / (h + 1) * rate END AS zr
            FROM ranked WHERE place = 1),
        scored AS (SELECT *, 1 / (1 + exp(-zl)) AS pl, 1 / (1 + exp(-zr)) AS pr FROM leaves),
        tried AS (
            SELECT trial_id, features, rate AS learning_rate, weight AS min_child_weight,
                   least_gain AS gamma,
                   round(sqrt((sl * (1 - pl) * (1 - pl) + (nl - sl) * pl * pl
                       + (s - sl) * (1 - pr) * (1 - pr) + ((n - nl) - (s - sl)) * pr * pr) / n), 9)
                       AS train_rmse
            FROM scored)
"""

# Running margins of the fixed ensemble, one for each round.
_MARGINS = ", ".join(
    " + ".join(
        f"{w}::DOUBLE * CASE WHEN {f} <= {at} THEN {low}::DOUBLE ELSE {high}::DOUBLE END"
        for f, at, low, high, w in STUMPS[: n + 1]
    )
    for n in range(len(STUMPS))
)

# A label that features tell: the weekend or a high price, not both.
_PLANTED = f"""CASE WHEN (event_weekday >= {PLANTED_WEEKDAY}) <> (price > {PLANTED_PRICE})
    THEN 1 ELSE 0 END"""

_RATE = """
        SELECT m - to_minutes(CAST(back AS BIGINT)) AS window_start, event_type,
               count(*) / 300.0::DOUBLE AS rate
        FROM (SELECT date_trunc('minute', ts) AS m, event_type FROM events),
             (SELECT unnest(range(5)) AS back)
        GROUP BY ALL"""

_CATEGORIES = """
    SELECT e.event_id, p.brand, isodow(e.ts) - 1 AS event_weekday,
           split_part(p.category_code, '.', 1) AS category_code_level1,
           substr(p.category_code, strpos(p.category_code, '.') + 1) AS category_code_level2
    FROM ev e LEFT JOIN products p USING (product_id)"""

_FACT = f"""
        SELECT md5({_FACT_KEY}) AS event_key, event_type, user_id, product_id, category_id,
               CAST(ts AS DATE) AS event_date, hour(ts) AS event_hour, ts AS event_timestamp,
               user_session, events_in_session
        FROM raw"""

ORACLE: dict[str, str] = {
    "vw_user_session_summary": _with("sess")
    + """
        SELECT c.c_custkey AS user_id, s.user_session, count(*) AS event_count,
               min(s.ts) AS session_start, max(s.ts) AS session_end,
               count(DISTINCT p.p_partkey) AS unique_products_viewed
        FROM sess s
        JOIN customer c ON s.user_id = c.c_custkey
        JOIN part p ON s.product_id = p.p_partkey
        GROUP BY c.c_custkey, s.user_session""",
    "vw_category_performance": _with("ev", "products")
    + """
        SELECT split_part(p.category_code, '.', 1) AS category_l1,
               split_part(p.category_code, '.', 2) AS category_l2,
               split_part(p.category_code, '.', 3) AS category_l3,
               count(*) AS view_count, count(DISTINCT c.c_custkey) AS unique_users,
               round(avg(CAST(p.price AS DECIMAL(10,2))), 6) AS avg_price
        FROM ev e
        JOIN products p ON e.product_id = p.product_id
        JOIN customer c ON e.user_id = c.c_custkey
        GROUP BY ALL""",
    "star_fact": _with("raw") + _FACT,
    "lookup_user_events": _with("raw")
    + f"{_FACT} WHERE user_id = (SELECT min(user_id) FROM events)",
    "lookup_session_events": _with("raw")
    + f"{_FACT} WHERE user_session = (SELECT min(user_id) || '-0' FROM events)",
    "lookup_product_events": _with("raw") + f"{_FACT} WHERE product_id = {LOOKUP_PRODUCT}",
    "lookup_category_events": _with("raw")
    + f"""{_FACT} WHERE category_id = (
        SELECT category_id FROM products WHERE product_id = {LOOKUP_PRODUCT})""",
    "lookup_cart_purchases": _with("sess")
    + f"""
        SELECT user_session, product_id, event_type, count(*) AS n FROM sess
        WHERE event_type IN ('click', 'purchase') AND product_id = {LOOKUP_PRODUCT}
        GROUP BY ALL""",
    "dim_user": "SELECT c_custkey AS user_id FROM customer",
    "dim_product": _with("products")
    + """
        SELECT product_id, brand, CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price,
               CASE WHEN price < 100 THEN 'budget' WHEN price < 500 THEN 'standard'
                    WHEN price < 950 THEN 'premium' ELSE 'luxury' END AS price_tier
        FROM products""",
    "dim_category": _with("products")
    + """
        SELECT DISTINCT category_id, category_code,
               split_part(category_code, '.', 1) AS category_l1,
               split_part(category_code, '.', 2) AS category_l2,
               split_part(category_code, '.', 3) AS category_l3
        FROM products""",
    "dim_date": """
        SELECT DISTINCT CAST(ts AS DATE) AS event_date, dayname(ts) AS day_of_week FROM events""",
    "events_in_session": _with("sess")
    + "SELECT user_session, event_id, events_in_session FROM sess",
    "session_event_counts": """
        SELECT user_id || '@' || CAST(ts AS DATE) AS user_session, event_id,
               count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS events_in_session
        FROM events""",
    "cart_purchase_events": _with("sess")
    + """
        SELECT event_id, event_type, user_session, product_id FROM sess
        WHERE event_type IN ('click', 'purchase')""",
    "fk_violations": _with("ev", "products")
    + """
        SELECT 'user_id' AS fk_name, count(*) AS violations FROM ev
        WHERE user_id IS NOT NULL
          AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)
        UNION ALL
        SELECT 'product_id', count(*) FROM ev
        WHERE product_id IS NOT NULL AND product_id NOT IN
              (SELECT product_id FROM products WHERE category_code NOT LIKE 'economy.%')
        UNION ALL
        SELECT 'category_id', count(*) FROM ev JOIN products p USING (product_id)
        WHERE p.category_id NOT IN
              (SELECT category_id FROM products WHERE category_code NOT LIKE 'economy.%')
        UNION ALL
        SELECT 'event_date', count(*) FROM ev
        WHERE ts >= TIMESTAMP '2024-01-20'""",
    "fk_violations_basic_products": _with("ev")
    + """
        SELECT 'product_id' AS fk_name, count(*) AS violations FROM ev
        WHERE product_id IS NOT NULL AND product_id NOT IN
              (SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY', 'SMALL'))""",
    "event_features": _with("feat") + "SELECT * EXCLUDE (ts) FROM feat",
    "training_projection": _with("feat")
    + """
        SELECT brand, price, event_weekday, category_code_level1, category_code_level2,
               activity_count, is_purchased FROM feat""",
    "filter_features": _with("feat")
    + """
        SELECT brand, price, event_weekday, category_code_level1, category_code_level2,
               activity_count, is_purchased FROM feat""",
    "fill_missing": _with("feat")
    + """
        , holes AS (
            SELECT * REPLACE (nullif(brand, 'Brand#13') AS brand,
                              CASE WHEN category_code_level1 <> 'economy' THEN price END AS price)
            FROM feat)
        SELECT event_id, coalesce(brand, 'unknown') AS brand,
               coalesce(price, (SELECT median(price) FROM holes)) AS price, event_weekday,
               category_code_level1, category_code_level2, activity_count, is_purchased
        FROM holes""",
    "price_median": _with("ev", "products")
    + "SELECT median(price) AS median_price FROM ev JOIN products USING (product_id)",
    "price_median_approximate": _with("ev", "products")
    + """
        SELECT count(price) AS prices, count(price) > 0 AS near_middle
        FROM ev JOIN products USING (product_id)""",
    "price_range": _with("ev", "products")
    + """
        SELECT min(price) AS min_price, max(price) AS max_price
        FROM ev JOIN products USING (product_id)""",
    "parse_timestamps": """
        SELECT event_id,
               CASE event_type
                   WHEN 'error' THEN '2024-13' || substr(CAST(ts AS VARCHAR), 8)
                   WHEN 'signup' THEN 'unknown' ELSE CAST(ts AS VARCHAR) END AS raw,
               CASE WHEN event_type NOT IN ('error', 'signup') THEN ts END AS parsed
        FROM events""",
    "category_mapping": _with("ev", "products")
    + f"""
        , cats AS ({_CATEGORIES}),
        vals AS (
            SELECT 'brand' AS col_name, brand AS value, NULL::BIGINT AS num FROM cats
            UNION SELECT 'event_weekday', CAST(event_weekday AS VARCHAR), event_weekday FROM cats
            UNION SELECT 'category_code_level1', category_code_level1, NULL FROM cats
            UNION SELECT 'category_code_level2', category_code_level2, NULL FROM cats)
        SELECT col_name, value,
               row_number() OVER (PARTITION BY col_name ORDER BY num, value) - 1 AS idx
        FROM vals WHERE value IS NOT NULL""",
    "encode_categories": _with("ev", "products")
    + f"""
        , cats AS ({_CATEGORIES}),
        seen AS (SELECT * FROM cats WHERE brand NOT IN ('Brand#7', 'Brand#13')),
        b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i
              FROM (SELECT DISTINCT brand AS v FROM seen)),
        w AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i
              FROM (SELECT DISTINCT event_weekday AS v FROM seen)),
        c1 AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i
               FROM (SELECT DISTINCT category_code_level1 AS v FROM seen)),
        c2 AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i
               FROM (SELECT DISTINCT category_code_level2 AS v FROM seen))
        SELECT event_id, coalesce(b.i, -1) AS brand, coalesce(w.i, -1) AS event_weekday,
               coalesce(c1.i, -1) AS category_code_level1,
               coalesce(c2.i, -1) AS category_code_level2
        FROM cats LEFT JOIN b ON brand = b.v LEFT JOIN w ON event_weekday = w.v
        LEFT JOIN c1 ON category_code_level1 = c1.v LEFT JOIN c2 ON category_code_level2 = c2.v""",
    "train_purchase_model": _with("feat")
    + f"""
        , parts AS (
            SELECT CASE WHEN CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT)
                             < CAST(floor(0.2 * 4294967296) AS BIGINT) THEN 'test'
                        WHEN CAST('0x' || substr(md5('43|' || event_id), 1, 8) AS BIGINT)
                             < CAST(floor(0.2 * 4294967296) AS BIGINT) THEN 'stop'
                        ELSE 'train' END AS part, {_PLANTED} AS y
            FROM feat)
        SELECT part, count(*) AS "rows", CAST(sum(y) AS BIGINT) AS purchases,
               round(avg(y) * (1 - avg(y)), 8) AS base_error, avg(y) * (1 - avg(y)) > 0 AS fits
        FROM parts GROUP BY part""",
    "metric_history": _with("feat")
    + f"""
        , parts AS (
            SELECT CASE WHEN CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT)
                             < CAST(floor(0.2 * 4294967296) AS BIGINT)
                        THEN 'test' ELSE 'train' END AS part, is_purchased AS y,
                   unnest(range({len(STUMPS)})) AS step, unnest([{_MARGINS}]) AS z
            FROM feat),
        scored AS (SELECT part, CAST(step AS INT) AS step, y, 1 / (1 + exp(-2 * z)) AS p FROM parts),
        ranks AS (
            SELECT *, rank() OVER (PARTITION BY part, step ORDER BY p)
                      + (count(*) OVER (PARTITION BY part, step, p) - 1) / 2.0 AS r FROM scored),
        sums AS (
            SELECT part, step, avg(-y * ln(p) - (1 - y) * ln(1 - p)) AS logloss,
                   avg(CASE WHEN (p > 0.5) <> (y = 1) THEN 1 ELSE 0 END) AS error,
                   sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
                   (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2)
                       / (sum(y) * (count(*) - sum(y))) AS auc
            FROM ranks GROUP BY part, step)
        SELECT part, step, 'logloss' AS metric, round(logloss::DOUBLE, 8) AS value FROM sums
        UNION ALL SELECT part, step, 'boosting_loss', round(2 * logloss::DOUBLE, 8) FROM sums
        UNION ALL SELECT part, step, 'error', round(error::DOUBLE, 8) FROM sums
        UNION ALL SELECT part, step, 'rmse', round(rmse::DOUBLE, 8) FROM sums
        UNION ALL SELECT part, step, 'mae', round(mae::DOUBLE, 8) FROM sums
        UNION ALL SELECT part, step, 'auc', round(auc::DOUBLE, 8) FROM sums
        UNION ALL SELECT part, step, 'accuracy', round(1 - error::DOUBLE, 8) FROM sums""",
    "train_test_split": """
        SELECT CASE WHEN CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT)
                         < CAST(floor(0.2 * 4294967296) AS BIGINT)
                    THEN 'test' ELSE 'train' END AS part, count(*) AS n
        FROM events GROUP BY 1""",
    "parse_notifications": """
        SELECT DISTINCT 's3a://bronze/data/' || strftime(ts, '%Y%m%d') || '/' || user_id || '.json'
               AS s3_path
        FROM events WHERE event_type IN ('view', 'purchase')""",
    "scan_csv": _with("raw")
    + """
        SELECT event_id, event_type, product_id, category_id, category_code, brand, price,
               user_id, user_session
        FROM raw""",
    "row_to_json": _with("feat")
    + """
        SELECT row_number() OVER (ORDER BY event_id) AS row_id,
               CAST(event_id AS VARCHAR) AS event_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
               CAST(user_id AS VARCHAR) AS user_id, CAST(product_id AS VARCHAR) AS product_id,
               user_session, CAST(price AS VARCHAR) AS price, brand, category_code_level1,
               category_code_level2, CAST(event_weekday AS VARCHAR) AS event_weekday,
               CAST(activity_count AS VARCHAR) AS activity_count,
               CAST(is_purchased AS VARCHAR) AS is_purchased
        FROM feat""",
    "scan_json": _with("feat")
    + """
        SELECT date_trunc('second', ts) AS event_timestamp, user_id, product_id, user_session,
               price, brand, category_code_level1, category_code_level2, event_weekday,
               activity_count, is_purchased
        FROM feat""",
    "partitioned_scan": _with("ev")
    + """
        SELECT event_id, event_type, user_id, product_id, ts AS event_timestamp,
               year(ts) AS year, month(ts) AS month, day(ts) AS day
        FROM ev WHERE CAST(ts AS DATE) = DATE '2024-01-07'""",
    "insert_ignore": """
        SELECT event_id, event_type,
               CASE WHEN ts < TIMESTAMP '2024-01-21' OR event_type <> 'error' THEN value END
                   AS value
        FROM events""",
    "landed_copy": _with("feat")
    + """
        SELECT date_trunc('second', ts) AS event_timestamp, user_id, product_id, user_session,
               price, brand, category_code_level1, category_code_level2, event_weekday,
               activity_count, is_purchased, event_id
        FROM feat""",
    "record_table": _with("raw")
    + f"""
        , timed AS (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM raw)
        SELECT DISTINCT {", ".join(_RECORD)},
               CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 'first' ELSE 'second' END
                   AS processing_pipeline,
               {_RECORD_VALID} AS valid,
               {_RECORD_HASH} AS record_hash
        FROM timed""",
    "online_features": _with("online") + _ONLINE.format(ts="ts"),
    "stream_online_features": _with("online") + _ONLINE.format(ts="date_trunc('second', ts)"),
    "stream_quarantine": """
        SELECT 'no key' AS reason, event_id, NULL AS document
        FROM events WHERE event_type = 'signup'
        UNION ALL
        SELECT 'malformed', NULL, '{"event_id": ' || event_id || ', broken'
        FROM events WHERE event_type = 'error'""",
    "stream_replay": _with("online")
    + """
        SELECT 'feature' AS kind,
               'user:' || user_id || ':product:' || product_id || ':session:' || user_session AS row
        FROM online
        UNION ALL
        SELECT 'set aside', CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'signup'
        UNION ALL
        SELECT 'set aside', '{"event_id": ' || event_id || ', broken'
        FROM events WHERE event_type = 'error'""",
    "numeric_default": _with("online")
    + """
        SELECT 'user:' || user_id || ':product:' || product_id || ':session:' || user_session
                   AS feature_key,
               0.0::DOUBLE AS brand, price, CAST(event_weekday AS DOUBLE) AS event_weekday,
               0.0::DOUBLE AS category_code_level1, 0.0::DOUBLE AS category_code_level2,
               CAST(activity_count AS DOUBLE) AS activity_count
        FROM online""",
    "record_hash": _with("ev") + f"SELECT event_id, sha256({_HASH}) AS record_hash FROM ev",
    "raw_records": _with("raw")
    + f"""
        , timed AS (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM raw)
        SELECT {", ".join(_RECORD)}, 'shop' AS processing_pipeline,
               {_RECORD_VALID} AS valid,
               {_RECORD_HASH} AS record_hash
        FROM timed""",
    "validate_events": "SELECT event_id, event_type <> 'signup' AS valid FROM events",
    "row_count_check": """
        SELECT suite, 'row_count' AS check_name, (SELECT count(*) FROM events) AS observed,
               min_value, 1000000::BIGINT AS max_value,
               (SELECT count(*) FROM events) BETWEEN min_value AND 1000000 AS success
        FROM (VALUES ('raw_data_suite', 0::BIGINT), ('gold_layer_suite', 1::BIGINT))
             t(suite, min_value)""",
    "load_metrics": _with("volumes")
    + """
        SELECT 'total_records' AS metric, total_records AS value FROM volumes
        UNION ALL SELECT 'valid_records', valid_records FROM volumes
        UNION ALL SELECT 'invalid_records', invalid_records FROM volumes
        UNION ALL SELECT 'duplicate_records', duplicate_records FROM volumes""",
    "load_alerts": _with("volumes")
    + """
        SELECT 'more_invalid_than_valid' AS rule,
               CAST(invalid_records > valid_records AS VARCHAR) AS fired FROM volumes
        UNION ALL SELECT 'many_duplicates', CAST(duplicate_records > 100 AS VARCHAR) FROM volumes
        UNION ALL SELECT 'low_volume', CAST(total_records < 100 AS VARCHAR) FROM volumes
        UNION ALL SELECT 'high_volume', CAST(total_records > 1000000 AS VARCHAR) FROM volumes
        UNION ALL SELECT 'long_processing', 'false'""",
    "feature_lookup": _with("answers")
    + """
        SELECT request_id, user_id, product_id, user_session, found, batch_ok FROM answers""",
    "store_lookup": _with("requests", "shop")
    + """
        SELECT r.*, s.user_id IS NOT NULL AS found,
               bool_and(s.user_id IS NOT NULL) OVER (PARTITION BY request_id) AS batch_ok,
               s.event_id, s.event_weekday, s.price
        FROM requests r LEFT JOIN shop s
          ON r.user_id = s.user_id AND r.product_id = s.product_id
         AND r.user_session = s.user_session""",
    "batch_score": _with("answers")
    + """
        SELECT request_id, user_id, product_id, user_session,
               CASE WHEN batch_ok THEN round(z / (1 + z), 9) END AS prediction,
               batch_ok AS success,
               CASE WHEN NOT batch_ok THEN 'Features not found' END AS error
        FROM answers""",
    "scoring_status_counts": _with("answers")
    + """
        SELECT batch_ok AS success, count(DISTINCT request_id) AS n, count(*) AS keys,
               round(sum(CASE WHEN batch_ok THEN z / (1 + z) END), 4) AS score_total
        FROM answers GROUP BY batch_ok""",
    "request_rate_5m": _RATE,
    "stream_request_rate_5m": _RATE,
    "stream_distinct_events": _with("ev")
    + "SELECT DISTINCT ts AS event_timestamp, event_type, user_id, product_id FROM ev",
    "stream_sessions": _with("numbered")
    + """
        SELECT user_id, count(*) AS event_count, min(ts) AS session_start, max(ts) AS session_end
        FROM numbered GROUP BY user_id, n""",
    "classification_metrics": _with("feat")
    + """
        , scored AS (SELECT is_purchased AS y, z / (1 + z) AS p FROM (
            SELECT is_purchased, 0.001::DOUBLE * price + 0.1::DOUBLE * event_weekday
                   + 0.05::DOUBLE * activity_count AS z FROM feat)),
        ranks AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0
                            AS r FROM scored),
        sums AS (SELECT avg(-y * ln(p) - (1 - y) * ln(1 - p)) AS logloss,
                        avg(CASE WHEN (p > 0.5) <> (y = 1) THEN 1 ELSE 0 END) AS error,
                        sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae FROM scored),
        auc AS (SELECT (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2)
                       / (sum(y) * (count(*) - sum(y))) AS auc FROM ranks)
        SELECT 'logloss' AS metric, round(logloss::DOUBLE, 8) AS value FROM sums
        UNION ALL SELECT 'error', round(error::DOUBLE, 8) FROM sums
        UNION ALL SELECT 'rmse', round(rmse::DOUBLE, 8) FROM sums
        UNION ALL SELECT 'mae', round(mae::DOUBLE, 8) FROM sums
        UNION ALL SELECT 'auc', round(auc::DOUBLE, 8) FROM auc
        UNION ALL SELECT 'accuracy', round(1 - error::DOUBLE, 8) FROM sums""",
    "search_trials": _SEARCH + "SELECT * FROM tried",
    "best_trial": _SEARCH + "SELECT * FROM tried ORDER BY train_rmse, trial_id LIMIT 1",
    "model_versions": """
        WITH kinds AS (SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users
                       FROM events GROUP BY event_type)
        SELECT event_type AS name, CAST(version AS INTEGER) AS version,
               'models:/' || event_type AS model_uri, '2024-02-01' AS training_date,
               '{"rows":' || n || ',"users":' || users || '}' AS metrics, 'Staging' AS stage,
               CASE WHEN version = 3 THEN 'current' END AS alias
        FROM kinds, range(1, 4) t(version)""",
    "latest_model": _with("registry")
    + """
        SELECT name, version, model_uri, training_date, metrics, 'current' AS alias
        FROM registry r
        WHERE version = (SELECT max(version) FROM registry x WHERE x.name = r.name)""",
    "latest_model_file": """
        SELECT strftime(max(CAST(ts AS DATE)), 'xgboost_model_%d_%m_%Y.ubj') AS file_name,
               max(CAST(ts AS DATE)) AS file_date
        FROM events WHERE event_type = 'purchase'""",
}
