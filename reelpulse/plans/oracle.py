"""DuckDB SQL for every query key: the same binding and the same report,
written independently as SQL over the driver's pre-registered views.

Sums and means are plain SUM and AVG.  ``rnd(x, n)`` rounds half-up on the
decimal text of a double, as Spark's ``round`` does; ``report(x, n)`` rounds as
``functions.columns.rounded`` does.
"""

from __future__ import annotations

import re


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding of the double's shortest decimal text (what Spark's
    ``round`` does); magnitudes beyond DECIMAL(38,17) are already whole."""
    text = f"TRY_CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR)"
    return (f"COALESCE(CAST(ROUND(TRY_CAST({text} AS DECIMAL(38,17)), {digits}) AS DOUBLE), "
            f"ROUND(CAST(({expr}) AS DOUBLE), {digits}))")


def report(expr: str, digits: int = 2) -> str:
    return rnd(rnd(expr, 6), digits)


def settled(expr: str) -> str:
    return rnd(rnd(expr, 9), 6)


def dsum(expr: str) -> str:
    return f"SUM({expr})"


def mean(expr: str) -> str:
    return f"AVG({expr})"


DEVICE = "CASE {c} % 4 WHEN 0 THEN 'TV' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Laptop' ELSE 'Tablet' END"
QUALITY = "CASE {c} % 3 WHEN 0 THEN 'SD' WHEN 1 THEN 'HD' ELSE '4K' END"


def _progress(w: str, d: str) -> str:
    pct = f"CASE WHEN {d} > 0 THEN {rnd(f'{w} / {d} * 100', 2)} ELSE 0.0 END"
    return f"CASE WHEN ({pct}) > 100.0 THEN 100.0 ELSE ({pct}) END"


def _first_row(source: str, key: str, cols: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in cols)
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, ROW_NUMBER() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS _rn FROM {source}) WHERE _rn = 1"
    )


MOVIE_COLS = ["movie_id", "title", "content_type", "genre_primary", "genre_secondary",
              "release_year", "duration_minutes", "imdb_rating", "is_netflix_original"]
USER_RAW_COLS = ["user_id", "age", "gender", "country", "state_province", "city",
                 "subscription_plan", "is_active", "monthly_spend", "primary_device"]

AGE_GROUP = ("CASE WHEN age < 18 THEN 'Children' WHEN age >= 18 AND age <= 35 THEN 'Young Adults' "
             "WHEN age >= 36 AND age <= 55 THEN 'Middle-aged' ELSE 'Senior' END")

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "ev": ("""
        SELECT event_id, ts, user_id, event_type, value, props,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""", ()),
    "user_country": ("""
        SELECT c.c_custkey, n.n_name AS location_country
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""", ()),
    "watch_events": (f"""
        SELECT e.event_id AS session_id, e.user_id, CASE WHEN e.k % 10 = 9 THEN CAST(e.k AS BIGINT) + 1000000000 ELSE CAST(e.k AS BIGINT) END AS movie_id,
               {DEVICE.format(c='e.event_id')} AS device_type,
               e.value AS watch_duration_minutes, 0.0::DOUBLE AS progress_percentage,
               CASE WHEN e.event_type = 'click' THEN 'paused' ELSE e.event_type END AS action,
               {QUALITY.format(c='e.event_id')} AS quality,
               CAST(e.k % 5 + 1 AS INTEGER) AS user_rating,
               uc.location_country,
               strftime(e.ts, '%Y%m%d%H') AS date_key,
               e.ts AS event_ts
        FROM ev e LEFT JOIN user_country uc ON e.user_id = uc.c_custkey
        WHERE e.event_type IN ('view', 'click', 'purchase')""", ("ev", "user_country")),
    "search_events": (f"""
        SELECT e.event_id AS search_id, e.user_id,
               'q' || CAST(e.k AS VARCHAR) AS search_query,
               CAST(e.k % 5 AS INTEGER) AS results_returned,
               CASE WHEN e.k % 5 = 0 THEN NULL ELSE CAST(e.k % 3 + 1 AS INTEGER) END AS clicked_result_position,
               e.value AS search_duration_seconds,
               CASE WHEN e.event_type = 'error' THEN 'True' ELSE 'False' END AS had_typo,
               {DEVICE.format(c='e.event_id')} AS device_type,
               uc.location_country,
               strftime(e.ts, '%Y%m%d%H') AS date_key,
               e.ts AS event_ts
        FROM ev e LEFT JOIN user_country uc ON e.user_id = uc.c_custkey
        WHERE e.event_type IN ('error', 'signup')""", ("ev", "user_country")),
    "movies_base": ("""
        SELECT p_partkey AS movie_id, p_name AS title,
               CASE WHEN p_size % 2 = 0 THEN 'Movie' ELSE 'TV Show' END AS content_type,
               p_type AS genre_primary, p_brand AS genre_secondary,
               CAST(p_partkey % 45 + 1980 AS INTEGER) AS release_year,
               CAST(p_size AS DOUBLE) * 5.0 AS duration_minutes,
               p_retailprice / 100 AS imdb_rating,
               (p_partkey % 7 = 0) AS is_netflix_original
        FROM part""", ()),
    "movies_raw": ("""
        SELECT * FROM movies_base
        UNION ALL
        SELECT movie_id, title || ' (re-release)', content_type, genre_primary, genre_secondary,
               release_year, duration_minutes, imdb_rating, is_netflix_original
        FROM movies_base WHERE movie_id % 25 = 0""", ("movies_base",)),
    "dim_movies": (_first_row("movies_raw", "movie_id", MOVIE_COLS), ("movies_raw",)),
    "users_base": (f"""
        SELECT c.c_custkey AS user_id, CAST(c.c_custkey % 70 + 10 AS DOUBLE) AS age,
               CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               n.n_name AS country,
               'State-' || CAST(c.c_nationkey % 5 AS VARCHAR) AS state_province,
               'City-' || CAST(c.c_custkey % 50 AS VARCHAR) AS city,
               c.c_mktsegment AS subscription_plan,
               (c.c_custkey % 10 <> 0) AS is_active,
               c.c_acctbal AS monthly_spend,
               {DEVICE.format(c='c.c_custkey')} AS primary_device
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""", ()),
    "users_raw": ("""
        SELECT * FROM users_base
        UNION ALL
        SELECT user_id, age, gender, country, state_province, city || '-moved', subscription_plan,
               is_active, monthly_spend, primary_device
        FROM users_base WHERE user_id % 25 = 0""", ("users_base",)),
    "dim_users": (f"""
        SELECT user_id, age, {AGE_GROUP} AS age_group, gender, country, state_province, city,
               subscription_plan, is_active, monthly_spend, primary_device
        FROM ({_first_row('users_raw', 'user_id', USER_RAW_COLS)})""", ("users_raw",)),
    "fact_watch": (f"""
        SELECT w.session_id, w.user_id, w.movie_id, w.device_type, w.watch_duration_minutes,
               {_progress('w.watch_duration_minutes', 'm.duration_minutes')} AS progress_percentage,
               w.action, w.quality, w.user_rating, w.location_country, w.date_key
        FROM watch_events w LEFT JOIN dim_movies m ON w.movie_id = m.movie_id""",
                   ("watch_events", "dim_movies")),
    "fact_search": ("""
        SELECT search_id, user_id, search_query, results_returned, clicked_result_position,
               search_duration_seconds, had_typo, device_type, location_country, date_key
        FROM search_events""", ("search_events",)),
    "dim_date": ("""
        SELECT date_key, ts AS full_timestamp,
               CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
               CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
               CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
               strftime(ts, '%a') AS day_name,
               COALESCE(dayofweek(ts) IN (0, 6), false) AS is_weekend,
               COALESCE(hour(ts) >= 22 OR hour(ts) <= 4, false) AS is_night
        FROM (SELECT date_key, try_strptime(date_key, '%Y%m%d%H') AS ts
              FROM (SELECT date_key FROM fact_watch UNION SELECT date_key FROM fact_search))""",
                 ("fact_watch", "fact_search")),
}


def with_ctes(select: str, extra: dict | None = None) -> str:
    """Prefix ``select`` with the CTEs it (transitively) mentions."""
    table = dict(CTES)
    table.update(extra or {})
    needed: list[str] = []

    def visit(name):
        if name in needed:
            return
        for dep in table[name][1]:
            visit(dep)
        needed.append(name)

    text = " ".join([select, *(sql for sql, _ in (extra or {}).values())])
    for name in table:
        if re.search(rf"\b{name}\b", text):
            visit(name)
    if not needed:
        return select
    body = ",\n".join(f"{n} AS ({table[n][0]})" for n in needed)
    return f"WITH RECURSIVE {body}\n{select}"


SQL: dict[str, str] = {}


def sql(name: str, select: str, extra: dict | None = None) -> None:
    SQL[name] = with_ctes(select, extra)


# --- C: reports ----------------------------------------------------------

sql("top_devices", """
    SELECT device_type, COUNT(session_id) AS total_views
    FROM fact_watch GROUP BY device_type""")

sql("genre_popularity", f"""
    SELECT m.genre_primary, COUNT(f.session_id) AS watch_count,
           {report(mean('m.imdb_rating'))} AS avg_imdb_rating,
           {report(mean('f.watch_duration_minutes'))} AS avg_watch_minutes
    FROM fact_watch f JOIN dim_movies m ON f.movie_id = m.movie_id
    GROUP BY m.genre_primary""")

sql("peak_hours", f"""
    SELECT d.hour, COUNT(DISTINCT f.user_id) AS active_users,
           {report(mean('f.progress_percentage'))} AS avg_progress_pct,
           {report(mean('f.watch_duration_minutes'))} AS avg_watch_duration
    FROM fact_watch f JOIN dim_date d ON f.date_key = d.date_key
    GROUP BY d.hour""")

sql("binge_genres", f"""
    SELECT m.genre_primary,
           {report(dsum('f.watch_duration_minutes'))} AS total_watch_duration,
           {report(mean('f.progress_percentage'))} AS avg_progress_pct
    FROM fact_watch f
    JOIN dim_date d ON f.date_key = d.date_key
    JOIN dim_movies m ON f.movie_id = m.movie_id
    WHERE d.is_night = true
    GROUP BY m.genre_primary""")

sql("churn_risk", f"""
    SELECT device_type, location_country, quality, COUNT(session_id) AS drop_events,
           {settled(mean('progress_percentage'))} AS avg_progress_at_drop,
           {settled(mean('watch_duration_minutes'))} AS avg_watch_duration
    FROM fact_watch
    WHERE progress_percentage < 10.0 AND action = 'paused'
    GROUP BY device_type, location_country, quality""")

sql("genre_popularity_order", """
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY n DESC, genre_primary NULLS FIRST) AS INTEGER) AS position, genre_primary
    FROM (SELECT m.genre_primary, COUNT(f.session_id) AS n
          FROM fact_watch f JOIN dim_movies m ON f.movie_id = m.movie_id GROUP BY m.genre_primary)""")

sql("failed_searches", """
    SELECT search_query, had_typo, COUNT(search_id) AS failed_count
    FROM fact_search WHERE results_returned = 0
    GROUP BY search_query, had_typo
    ORDER BY failed_count DESC, search_query ASC NULLS FIRST, had_typo ASC NULLS FIRST
    LIMIT 10""")

# --- B: warehouse --------------------------------------------------------

sql("dim_users", "SELECT * FROM dim_users")
sql("dim_movies", "SELECT * FROM dim_movies")
sql("dim_date", "SELECT * FROM dim_date")
sql("watch_progress", "SELECT * FROM fact_watch")

sql("batch_event_stats", """
    SELECT event_type, COUNT(*) AS count FROM (
        SELECT 'watch' AS event_type FROM watch_events
        WHERE session_id % 97 <> 0 AND user_id IS NOT NULL
        UNION ALL
        SELECT 'search' FROM search_events
        WHERE search_id % 97 <> 0 AND user_id IS NOT NULL)
    GROUP BY event_type""")

# --- data quality --------------------------------------------------------


def _nulls(table, src, key):
    return (f"SELECT '{table}' AS \"table\", '{key}' AS \"key\", "
            f"COUNT(*) FILTER (WHERE {key} IS NULL) AS null_count FROM {src}")


def _dups(table, src, key):
    return (f"SELECT '{table}' AS \"table\", '{key}' AS \"key\", "
            f"COUNT(*) FILTER (WHERE _n > 1) AS duplicate_keys "
            f"FROM (SELECT {key}, COUNT(*) AS _n FROM {src} GROUP BY {key})")


def _dimrep(table, src, key):
    return (f"SELECT '{table}' AS \"table\", '{key}' AS \"key\", null_count, duplicate_keys, "
            f"(null_count = 0 AND duplicate_keys = 0) AS ok FROM ("
            f"SELECT CAST(COALESCE(SUM(_n) FILTER (WHERE {key} IS NULL), 0) AS BIGINT) AS null_count, "
            f"COUNT(*) FILTER (WHERE _n > 1) AS duplicate_keys "
            f"FROM (SELECT {key}, COUNT(*) AS _n FROM {src} GROUP BY {key}))")


sql("dq_null_keys", " UNION ALL ".join([
    _nulls("fact_watch", "fact_watch", "movie_id"),
    _nulls("dim_users", "users_raw", "user_id"),
    _nulls("dim_movies", "movies_raw", "movie_id"),
    _nulls("dim_date", "dim_date", "date_key"),
]))

sql("dq_duplicate_keys", " UNION ALL ".join([
    _dups("dim_users", "users_raw", "user_id"),
    _dups("dim_movies", "movies_raw", "movie_id"),
    _dups("dim_date", "dim_date", "date_key"),
]))

sql("dq_dimension_report", " UNION ALL ".join([
    _dimrep("dim_users_raw", "users_raw", "user_id"),
    _dimrep("dim_movies_raw", "movies_raw", "movie_id"),
    _dimrep("dim_users", "dim_users", "user_id"),
    _dimrep("dim_movies", "dim_movies", "movie_id"),
    _dimrep("dim_date", "dim_date", "date_key"),
]))

sql("dq_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS \"rows\" FROM {src}"
    for t, src in [("dim_users", "dim_users"), ("dim_movies", "dim_movies"), ("dim_date", "dim_date"),
                   ("fact_watch_history", "fact_watch"), ("fact_search_logs", "fact_search")]
))


def _ri(fact_name, fact, fk, dim_name, dim, pk):
    return (f"SELECT '{fact_name}' AS fact, '{fk}' AS fk, '{dim_name}' AS dim, "
            f"COUNT(*) FILTER (WHERE f.{fk} IS NULL) AS null_fk, COUNT(f.{fk}) AS unmatched_fk, "
            f"COUNT(*) AS orphans FROM {fact} f "
            f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})")


sql("ri_report", " UNION ALL ".join([
    _ri("fact_watch_history", "fact_watch", "user_id", "dim_users", "dim_users", "user_id"),
    _ri("fact_watch_history", "fact_watch", "movie_id", "dim_movies", "dim_movies", "movie_id"),
    _ri("fact_watch_history", "fact_watch", "date_key", "dim_date", "dim_date", "date_key"),
    _ri("fact_search_logs", "fact_search", "user_id", "dim_users", "dim_users", "user_id"),
    _ri("fact_search_logs", "fact_search", "date_key", "dim_date", "dim_date", "date_key"),
]))

sql("ri_orphans", """
    SELECT f.* FROM fact_watch f
    WHERE NOT EXISTS (SELECT 1 FROM dim_movies m WHERE m.movie_id = f.movie_id)""")

_SAMPLES = []
for _fact, _src, _id, _fk, _dim, _pk in (
        ("fact_watch_history", "fact_watch", "session_id", "user_id", "dim_users", "user_id"),
        ("fact_watch_history", "fact_watch", "session_id", "movie_id", "dim_movies", "movie_id"),
        ("fact_watch_history", "fact_watch", "session_id", "date_key", "dim_date", "date_key"),
        ("fact_search_logs", "fact_search", "search_id", "user_id", "dim_users", "user_id"),
        ("fact_search_logs", "fact_search", "search_id", "date_key", "dim_date", "date_key")):
    _SAMPLES.append(f"""
        SELECT * FROM (
            SELECT '{_fact}' AS fact, '{_fk}' AS fk, '{_dim}' AS dim, CAST(f.{_id} AS VARCHAR) AS sample_id,
                   CAST(f.{_fk} AS VARCHAR) AS fk_value,
                   CASE WHEN f.{_fk} IS NULL THEN 'null' ELSE 'unmatched' END AS reason
            FROM {_src} f WHERE NOT EXISTS (SELECT 1 FROM {_dim} d WHERE d.{_pk} = f.{_fk})
            ORDER BY f.{_id} NULLS LAST, f.{_fk} NULLS FIRST LIMIT 5)""")
sql("ri_samples", " UNION ALL ".join(_SAMPLES))

# --- E: telemetry --------------------------------------------------------

TS_FMT = "%Y-%m-%d %H:%M:%S"
TEL_COLS = "timestamp, user_id, video_id, genre, video_title, watch_time_minutes, device_type"

CTES.update({
    "telemetry_base": (f"""
        SELECT CASE WHEN e.event_id % 40 = 3 THEN 'CORRUPT_TIMESTAMP'
                    ELSE strftime(e.ts, '{TS_FMT}') END AS timestamp,
               CASE WHEN e.event_id % 40 = 1 THEN '' ELSE 'USER_' || CAST(e.user_id AS VARCHAR) END AS user_id,
               'V' || CAST(e.k AS VARCHAR) AS video_id,
               p.p_type AS genre,
               CASE WHEN e.event_id % 40 = 4 THEN '' ELSE p.p_name END AS video_title,
               CASE WHEN e.event_id % 40 = 2 THEN -CAST(floor(e.value * 10) AS INTEGER)
                    ELSE CAST(floor(e.value * 10) AS INTEGER) END AS watch_time_minutes,
               {DEVICE.format(c='e.event_id')} AS device_type,
               e.event_id
        FROM ev e LEFT JOIN part p ON e.k = p.p_partkey""", ("ev",)),
    "telemetry_raw": (f"""
        SELECT {TEL_COLS} FROM telemetry_base
        UNION ALL
        SELECT {TEL_COLS} FROM telemetry_base WHERE event_id % 100 = 7""", ("telemetry_base",)),
    "telemetry_clean": (f"""
        SELECT try_strptime(timestamp, '{TS_FMT}') AS timestamp, user_id, video_id, genre,
               video_title, watch_time_minutes, device_type
        FROM (SELECT DISTINCT {TEL_COLS} FROM telemetry_raw)
        WHERE user_id <> '' AND user_id IS NOT NULL AND video_title <> '' AND video_title IS NOT NULL
          AND watch_time_minutes > 0 AND try_strptime(timestamp, '{TS_FMT}') IS NOT NULL""",
                        ("telemetry_raw",)),
})

sql("telemetry_clean", "SELECT * FROM telemetry_clean")

_FUNNEL_STEPS = ["raw", "deduplicated", "valid_user_title", "positive_minutes", "valid_timestamp"]
_funnel_totals = f"""
    SELECT CAST(COALESCE(SUM(_n), 0) AS BIGINT) AS raw, COUNT(*) AS deduplicated,
           COUNT(*) FILTER (WHERE _info) AS valid_user_title,
           COUNT(*) FILTER (WHERE _info AND watch_time_minutes > 0) AS positive_minutes,
           COUNT(*) FILTER (WHERE _info AND watch_time_minutes > 0
                            AND try_strptime(timestamp, '{TS_FMT}') IS NOT NULL) AS valid_timestamp
    FROM (SELECT {TEL_COLS}, COUNT(*) AS _n,
                 (user_id <> '' AND user_id IS NOT NULL AND video_title <> '' AND video_title IS NOT NULL) AS _info
          FROM telemetry_raw GROUP BY ALL)"""
sql("cleaning_funnel", " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS step_no, '{s}' AS step, {s} AS \"rows\", "
    f"{(_FUNNEL_STEPS[i - 1] if i else s)} - {s} AS removed, "
    f"{rnd(f'CAST({s} AS DOUBLE) * 100.0 / CAST(raw AS DOUBLE)', 2)} AS pct_of_raw "
    f"FROM ({_funnel_totals})"
    for i, s in enumerate(_FUNNEL_STEPS)
))

sql("top_users", """
    SELECT user_id, CAST(SUM(watch_time_minutes) AS BIGINT) AS Total_Minutes
    FROM telemetry_clean GROUP BY user_id
    ORDER BY Total_Minutes DESC, user_id ASC NULLS FIRST LIMIT 5""")

sql("trending_videos", """
    SELECT video_title, COUNT(*) AS Views FROM telemetry_clean GROUP BY video_title
    ORDER BY Views DESC, video_title ASC NULLS FIRST LIMIT 5""")

sql("telemetry_peak_hours", """
    SELECT CAST(hour(timestamp) AS INTEGER) AS hour, COUNT(*) AS count
    FROM telemetry_clean GROUP BY 1
    ORDER BY count DESC, hour ASC NULLS FIRST LIMIT 5""")

sql("genre_watch_stats", f"""
    SELECT genre, CAST(SUM(watch_time_minutes) AS BIGINT) AS total,
           {settled(mean('watch_time_minutes'))} AS average,
           MIN(watch_time_minutes) AS shortest, MAX(watch_time_minutes) AS longest
    FROM telemetry_clean GROUP BY genre""")

sql("telemetry_anomalies", """
    SELECT timestamp, user_id, video_title, watch_time_minutes, device_type
    FROM telemetry_clean WHERE watch_time_minutes >= 1440""")

sql("telemetry_anomalies_top", """
    SELECT timestamp, user_id, video_title, watch_time_minutes, device_type
    FROM telemetry_clean WHERE watch_time_minutes >= 1440
    ORDER BY watch_time_minutes DESC, timestamp ASC NULLS FIRST, user_id ASC NULLS FIRST,
             video_title ASC NULLS FIRST, device_type ASC NULLS FIRST
    LIMIT 10""")

# --- F: lakehouse --------------------------------------------------------

CTES.update({
    "orders_base": (f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status,
               CASE WHEN o_orderkey % 40 = 0 THEN 'not a time'
                    ELSE strftime(o_orderdate, '{TS_FMT}') END AS order_purchase_timestamp,
               o_orderkey
        FROM orders""", ()),
    "orders_csv": ("""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM orders_base
        UNION ALL
        SELECT order_id, customer_id, 'X', order_purchase_timestamp FROM orders_base
        WHERE o_orderkey % 30 = 0""", ("orders_base",)),
    "items_csv": (f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CASE WHEN (l_orderkey * 7 + l_linenumber) % 60 = 0 THEN 'abc'
                    WHEN (l_orderkey * 7 + l_linenumber) % 60 = 1 THEN '-1.00'
                    ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
               CAST({rnd('l_extendedprice * l_tax', 2)} AS VARCHAR) AS freight_value
        FROM lineitem""", ()),
    "products_csv": ("""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_type END AS product_category_name,
               CAST(p_size AS VARCHAR) AS product_weight_g
        FROM part""", ()),
    "reviews_csv": ("""
        SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_orderkey % 50 = 0 THEN 'bad' ELSE substr(o_orderpriority, 1, 1) END AS review_score
        FROM orders""", ()),
    "silver_orders": (f"""
        SELECT order_id, customer_id, order_status,
               try_strptime(order_purchase_timestamp, '{TS_FMT}') AS order_purchase_timestamp
        FROM ({_first_row('orders_csv', 'order_id',
                          ['order_id', 'customer_id', 'order_status', 'order_purchase_timestamp'])})""",
                      ("orders_csv",)),
    "silver_items": ("""
        SELECT order_id, order_item_id, product_id, TRY_CAST(price AS DOUBLE) AS price,
               TRY_CAST(freight_value AS DOUBLE) AS freight_value
        FROM items_csv
        WHERE TRY_CAST(price AS DOUBLE) >= 0 AND TRY_CAST(freight_value AS DOUBLE) >= 0""",
                     ("items_csv",)),
    "silver_products": ("""
        SELECT product_id, COALESCE(product_category_name, 'unknown') AS product_category_name,
               product_weight_g
        FROM products_csv""", ("products_csv",)),
    "silver_reviews": ("""
        SELECT review_id, order_id, TRY_CAST(review_score AS INTEGER) AS review_score
        FROM reviews_csv WHERE TRY_CAST(review_score AS INTEGER) IS NOT NULL""", ("reviews_csv",)),
})

sql("bronze_orders", "SELECT * FROM orders_csv")
sql("silver_orders", "SELECT * FROM silver_orders")
sql("silver_items", "SELECT * FROM silver_items")
sql("silver_products", "SELECT * FROM silver_products")
sql("silver_reviews", "SELECT * FROM silver_reviews")
sql("silver_schema_lock", """
    SELECT a.attempt, a.accepted, s."rows", s."columns"
    FROM (SELECT 'same_schema' AS attempt, true AS accepted
          UNION ALL SELECT 'changed_schema', false) a,
         (SELECT COUNT(*) AS "rows", 5 AS "columns" FROM silver_items) s""")

sql("gold_sales_daily", f"""
    SELECT CAST(o.order_purchase_timestamp AS DATE) AS sales_date,
           {settled(dsum('i.price'))} AS total_item_revenue,
           {settled(dsum('i.freight_value'))} AS total_freight_cost,
           COUNT(o.order_id) AS total_order_items_sold
    FROM silver_orders o JOIN silver_items i ON o.order_id = i.order_id
    GROUP BY 1""")

sql("gold_sales_daily_order", """
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY d NULLS FIRST) AS INTEGER) AS position, d AS sales_date
    FROM (SELECT DISTINCT CAST(o.order_purchase_timestamp AS DATE) AS d
          FROM silver_orders o JOIN silver_items i ON o.order_id = i.order_id)""")

sql("silver_stamp", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS \"rows\", COUNT(*) AS stamped FROM silver_{t}"
    for t in ("orders", "items", "products", "reviews")))

sql("gold_category_performance", f"""
    SELECT p.product_category_name, {settled(dsum('i.price'))} AS total_category_revenue,
           COUNT(i.product_id) AS total_units_sold
    FROM silver_items i JOIN silver_products p ON i.product_id = p.product_id
    GROUP BY 1""")

sql("gold_product_satisfaction", """
    SELECT p.product_category_name,
           CAST(SUM(r.review_score) AS DOUBLE) / CAST(COUNT(r.review_score) AS DOUBLE) AS avg_customer_rating,
           COUNT(r.review_id) AS total_reviews_received
    FROM silver_reviews r
    JOIN silver_items i ON r.order_id = i.order_id
    JOIN silver_products p ON i.product_id = p.product_id
    GROUP BY 1""")

# --- G: social documents -------------------------------------------------

SOCIAL_AS_OF = "2024-06-30"

CTES.update({
    "social_users_csv": ("""
        SELECT CAST(c.c_custkey AS INTEGER) AS UserID, c.c_name AS Name,
               CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
               CASE WHEN c.c_custkey % 30 = 0 THEN 'unknown'
                    ELSE strftime(DATE '1950-01-01' + CAST(c.c_custkey * 97 % 18000 AS INTEGER), '%Y-%m-%d')
               END AS DOB,
               'City-' || CAST(c.c_custkey % 50 AS VARCHAR) AS City,
               n.n_name AS Country
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""", ()),
    "social_users": (f"""
        SELECT UserID AS user_id, Name AS name, Gender AS gender,
               CAST(year(DATE '{SOCIAL_AS_OF}') - year(try_strptime(DOB, '%Y-%m-%d')) AS INTEGER) AS age,
               City AS city, Country AS country
        FROM social_users_csv""", ("social_users_csv",)),
    "social_posts": ("""
        SELECT CAST(doc_id AS INTEGER) AS post_id, '2024-01-01 00:00:00' AS timestamp,
               source AS category,
               CASE WHEN n_chars % 3 = 0 THEN 'positive' WHEN n_chars % 3 = 1 THEN 'neutral'
                    ELSE 'negative' END AS sentiment,
               lang AS language,
               CAST(n_chars % 1000 AS INTEGER) AS likes, CAST(n_chars % 100 AS INTEGER) AS comments,
               CAST(n_chars % 10 AS INTEGER) AS shares, CAST(doc_id % 2 AS INTEGER) AS is_spam
        FROM documents""", ()),
    "social_feeds": ("""
        SELECT event_id AS feed_id, user_id, CAST(k AS BIGINT) AS post_id, event_type AS action,
               ts AS timestamp
        FROM ev""", ("ev",)),
})

sql("social_users_load", "SELECT * FROM social_users")
sql("social_posts_load", "SELECT * FROM social_posts")
sql("social_action_distribution", "SELECT action, COUNT(*) AS count FROM social_feeds GROUP BY action")
sql("social_top_categories", """
    SELECT category, COUNT(*) AS posts FROM social_posts GROUP BY category
    ORDER BY posts DESC, category ASC NULLS FIRST LIMIT 5""")
_TOP_USERS = """
    SELECT user_id, COUNT(*) AS total_actions FROM social_feeds GROUP BY user_id
    ORDER BY total_actions DESC, user_id ASC NULLS FIRST LIMIT 5"""
sql("social_top_users", _TOP_USERS)
sql("social_top_users_detail", f"""
    SELECT t.user_id, u.name, u.country, t.total_actions
    FROM ({_TOP_USERS}) t JOIN social_users u ON t.user_id IS NOT DISTINCT FROM u.user_id""")

# --- H: serving ----------------------------------------------------------

SPEED_FROM_KEY = "2024011600"

sql("lambda_merge_genre", f"""
    SELECT genre_primary, CAST(SUM(c) AS BIGINT) AS total FROM (
        SELECT m.genre_primary, COUNT(f.session_id) AS c
        FROM fact_watch f JOIN dim_movies m ON f.movie_id = m.movie_id
        WHERE f.date_key < '{SPEED_FROM_KEY}' GROUP BY m.genre_primary
        UNION ALL
        SELECT m.genre_primary, COUNT(*) AS c
        FROM fact_watch f LEFT JOIN dim_movies m ON f.movie_id = m.movie_id
        WHERE f.date_key >= '{SPEED_FROM_KEY}' GROUP BY m.genre_primary)
    WHERE genre_primary IS NOT NULL GROUP BY genre_primary""")

sql("lambda_merge_device", f"""
    SELECT device_type, CAST(SUM(c) AS BIGINT) AS total FROM (
        SELECT device_type, COUNT(session_id) AS c FROM fact_watch
        WHERE date_key < '{SPEED_FROM_KEY}' GROUP BY device_type
        UNION ALL
        SELECT device_type, COUNT(*) AS c FROM fact_watch
        WHERE date_key >= '{SPEED_FROM_KEY}' GROUP BY device_type)
    WHERE device_type IS NOT NULL GROUP BY device_type""")

CTES["user_features"] = (f"""
    SELECT f.user_id,
           CAST(COUNT(f.session_id) AS DOUBLE) AS total_views,
           COALESCE({dsum('f.watch_duration_minutes')}, 0.0) AS total_duration_minutes,
           COALESCE({mean('f.progress_percentage')}, 0.0) AS avg_progress_percentage,
           COALESCE(CAST(SUM(CASE WHEN d.is_night = true THEN 1 ELSE 0 END) AS DOUBLE)
                    / CAST(COUNT(*) AS DOUBLE), 0.0) AS night_view_ratio
    FROM fact_watch f JOIN dim_date d ON f.date_key = d.date_key
    GROUP BY f.user_id""", ("fact_watch", "dim_date"))

_FEATURES = ["total_views", "total_duration_minutes", "avg_progress_percentage", "night_view_ratio"]
sql("user_features", "SELECT user_id, " + ", ".join(f"{settled(c)} AS {c}" for c in _FEATURES) + " FROM user_features")

CTES["rule_clusters"] = ("SELECT *, CAST(user_id % 3 AS INTEGER) AS cluster_id FROM user_features", ("user_features",))
CTES["rule_centroids"] = (f"""
    SELECT cluster_id, {report("AVG(total_views)")} AS total_views_center,
           {report("AVG(total_duration_minutes)")} AS duration_center,
           {report("AVG(avg_progress_percentage)")} AS progress_center,
           {report("AVG(night_view_ratio)", 4)} AS night_ratio_center
    FROM rule_clusters GROUP BY cluster_id""", ("rule_clusters",))
CTES["rule_owl"] = ("""
    SELECT cluster_id AS owl FROM rule_centroids ORDER BY night_ratio_center DESC, cluster_id LIMIT 1""",
                    ("rule_centroids",))
CTES["rule_fan"] = ("""
    SELECT cluster_id AS fan FROM rule_centroids WHERE cluster_id <> (SELECT owl FROM rule_owl)
    ORDER BY duration_center DESC, cluster_id LIMIT 1""", ("rule_owl",))
CTES["rule_segments"] = ("""
    SELECT *, CASE WHEN cluster_id = (SELECT owl FROM rule_owl) THEN 'Cú đêm'
                   WHEN cluster_id = (SELECT fan FROM rule_fan) THEN 'Mọt phim'
                   ELSE 'Xem giải trí' END AS segment_name
    FROM rule_clusters""", ("rule_clusters", "rule_owl", "rule_fan"))
_SETTLED_FEATURES = ", ".join(f"{settled(c)} AS {c}" for c in _FEATURES)
sql("rule_cluster_counts", "SELECT cluster_id, COUNT(*) AS count FROM rule_clusters GROUP BY cluster_id")
sql("rule_cluster_centroids", "SELECT * FROM rule_centroids")
sql("rule_user_segments", f"SELECT user_id, {_SETTLED_FEATURES}, cluster_id, segment_name FROM rule_segments")
sql("rule_segment_counts", "SELECT segment_name, COUNT(*) AS count FROM rule_segments GROUP BY segment_name")
sql("rule_segment_names", "SELECT DISTINCT segment_name FROM rule_segments")
sql("rule_segment_profile", "SELECT segment_name, " + ", ".join(
    f"{settled(f'AVG({c})')} AS {c}" for c in _FEATURES) + " FROM rule_segments GROUP BY segment_name")
sql("rule_segment_lookup", f"""
    SELECT user_id, {_SETTLED_FEATURES}, segment_name FROM rule_segments WHERE segment_name = 'Cú đêm'""")
sql("preview_sample", """
    SELECT LEAST(5, COUNT(*)) AS "rows", LEAST(5, COUNT(*)) AS present FROM fact_watch""")

sql("kpi_summary", f"""
    SELECT COUNT(*) AS total_users, {settled(mean('total_duration_minutes'))} AS avg_duration,
           {settled(mean('avg_progress_percentage'))} AS avg_progress
    FROM user_features""")

_Z = ["total_views", "total_duration_minutes", "avg_progress_percentage", "night_view_ratio"]
sql("scaled_features", "SELECT user_id, " + ", ".join(
    f"{rnd(f'CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END', 6)} AS z_{c}"
    for c in _Z) + " FROM user_features")

# --- D: K-Means in SQL ---------------------------------------------------
# The same points, seeds and Lloyd steps: seeds farthest first in the order of the
# MD5 of the id; every K starts from the first K seeds; at most 20 steps, until no
# centre moves by more than 1e-4; an empty cluster keeps its centre.
_ZS = ["z1", "z2", "z3", "z4"]


def _sq(a: str, b: str) -> str:
    return " + ".join(f"({a}.{z} - {b}.{z}) * ({a}.{z} - {b}.{z})" for z in _ZS)


CTES["km_points"] = (f"""
    SELECT user_id, md5(CAST(user_id AS VARCHAR)) AS h, """ + ", ".join(
    f"round(CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END, 9) AS {z}"
    for c, z in zip(_FEATURES, _ZS, strict=True)) + " FROM user_features", ("user_features",))
for _j in range(8):
    _near = " , ".join(f"({_sq('p', f's{i}')})" for i in range(_j))
    _from = "km_points p" + "".join(f" CROSS JOIN km_seed{i} s{i}" for i in range(_j))
    _rank = f"LEAST({_near}, 1e300) DESC, p.h, p.user_id" if _j else "p.h, p.user_id"
    CTES[f"km_seed{_j}"] = (f"SELECT p.z1, p.z2, p.z3, p.z4 FROM {_from} ORDER BY {_rank} LIMIT 1",
                            ("km_points", *(f"km_seed{i}" for i in range(_j))))
CTES["km_seeds"] = (" UNION ALL ".join(f"SELECT {j} AS j, * FROM km_seed{j}" for j in range(8)),
                    tuple(f"km_seed{j}" for j in range(8)))
CTES["km_steps"] = (f"""
    SELECT 0 AS it, k, j, z1, z2, z3, z4, CAST(1e300 AS DOUBLE) AS moved
    FROM km_seeds JOIN (SELECT UNNEST(range(2, 9)) AS k) ks ON j < k
    UNION ALL
    SELECT it, k, j, m1, m2, m3, m4, MAX(step) OVER (PARTITION BY k) AS moved
    FROM (
        SELECT c.it + 1 AS it, c.k, c.j, COALESCE(m.z1, c.z1) AS m1, COALESCE(m.z2, c.z2) AS m2,
               COALESCE(m.z3, c.z3) AS m3, COALESCE(m.z4, c.z4) AS m4, COALESCE({_sq('m', 'c')}, 0.0) AS step
        FROM km_steps c LEFT JOIN (
            SELECT k, j, AVG(z1) AS z1, AVG(z2) AS z2, AVG(z3) AS z3, AVG(z4) AS z4
            FROM (SELECT p.*, c.k, c.j, ROW_NUMBER() OVER (PARTITION BY c.k, p.user_id ORDER BY {_sq('p', 'c')}, c.j) AS near
                  FROM km_points p CROSS JOIN km_steps c WHERE c.it < 20 AND c.moved > 1e-8)
            WHERE near = 1 GROUP BY k, j) m ON m.k = c.k AND m.j = c.j
        WHERE c.it < 20 AND c.moved > 1e-8)""", ("km_points", "km_seeds"))
CTES["km_assigned"] = (f"""
    SELECT * FROM (
        SELECT p.*, c.k, CAST(c.j AS INTEGER) AS cluster_id, {_sq('p', 'c')} AS cost,
               ROW_NUMBER() OVER (PARTITION BY c.k, p.user_id ORDER BY {_sq('p', 'c')}, c.j) AS near
        FROM km_points p CROSS JOIN (SELECT * FROM km_steps QUALIFY it = MAX(it) OVER (PARTITION BY k)) c)
    WHERE near = 1""", ("km_points", "km_steps"))
_NORM = " + ".join(f"{z} * {z}" for z in _ZS)


def _silhouettes(source: str) -> str:
    """Mean silhouette per k of rows (k, cluster_id, z1..z4) over all pairs' means."""
    dot = " + ".join(f"p.{z} * g.y{z}" for z in _ZS)
    return f"""
        SELECT k, AVG(CASE WHEN n = 1 OR a = b THEN 0.0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END) AS silhouette
        FROM (
            SELECT p.k, p.user_id, MAX(g.n) FILTER (WHERE g.cluster_id = p.cluster_id) AS n,
                   MAX(d * g.n / GREATEST(g.n - 1, 1)) FILTER (WHERE g.cluster_id = p.cluster_id) AS a,
                   MIN(d) FILTER (WHERE g.cluster_id <> p.cluster_id) AS b
            FROM (SELECT p.k, p.user_id, p.cluster_id, g.cluster_id AS other, ({_NORM}) + g.s / g.n - 2.0 * ({dot}) / g.n AS d
                  FROM {source} p JOIN groups_of g ON g.k = p.k) p
            JOIN groups_of g ON g.k = p.k AND g.cluster_id = p.other GROUP BY p.k, p.user_id)
        GROUP BY k"""


def _groups_of(source: str) -> str:
    sums = ", ".join(f"SUM({z}) AS y{z}" for z in _ZS)
    return f"SELECT k, cluster_id, COUNT(*) AS n, SUM({_NORM}) AS s, {sums} FROM {source} GROUP BY k, cluster_id"


CTES["groups_of"] = (_groups_of("km_assigned"), ("km_assigned",))
CTES["km_silhouette"] = (_silhouettes("km_assigned"), ("km_assigned", "groups_of"))
sql("kmeans_sweep", f"""
    SELECT CAST(c.k AS INTEGER) AS k, {settled('c.cost')} AS cost, {settled('s.silhouette')} AS silhouette
    FROM (SELECT k, SUM(cost) AS cost FROM km_assigned GROUP BY k) c JOIN km_silhouette s ON s.k = c.k""")
SQL["rule_silhouette"] = with_ctes(f"""
    SELECT {settled('silhouette')} AS silhouette FROM km_silhouette""", {
    "km_assigned": ("SELECT 0 AS k, *, CAST(user_id % 3 AS INTEGER) AS cluster_id FROM km_points", ("km_points",))})
CTES["fit_clusters"] = ("""
    SELECT f.*, a.cluster_id FROM user_features f JOIN km_assigned a ON a.user_id = f.user_id AND a.k = 3""",
                        ("user_features", "km_assigned"))
for _name in ("centroids", "owl", "fan", "segments"):
    _text, _deps = CTES[f"rule_{_name}"]
    _fit = lambda x: re.sub(r"\brule_(clusters|centroids|owl|fan|segments)\b", r"fit_\1", x)
    CTES[f"fit_{_name}"] = (_fit(_text), tuple(_fit(x) for x in _deps))
sql("cluster_counts", "SELECT cluster_id, COUNT(*) AS count FROM fit_clusters GROUP BY cluster_id")
sql("cluster_centroids", "SELECT * FROM fit_centroids")
sql("user_segments", f"SELECT user_id, {_SETTLED_FEATURES}, cluster_id, segment_name FROM fit_segments")
sql("segment_counts", "SELECT segment_name, COUNT(*) AS count FROM fit_segments GROUP BY segment_name")
sql("segment_profile", "SELECT segment_name, " + ", ".join(
    f"{settled(f'AVG({c})')} AS {c}" for c in _FEATURES) + " FROM fit_segments GROUP BY segment_name")
sql("segment_lookup", f"""
    SELECT user_id, {_SETTLED_FEATURES}, segment_name FROM fit_segments WHERE segment_name = 'Cú đêm'""")

# --- B: views, fallback, encoding ----------------------------------------

sql("global_view_query", """
    SELECT device_type, COUNT(session_id) AS total_views FROM fact_watch GROUP BY device_type""")

sql("view_query", """
    SELECT m.content_type, COUNT(f.session_id) AS total_views
    FROM fact_watch f JOIN dim_movies m ON f.movie_id = m.movie_id GROUP BY m.content_type""")

sql("dim_fallback", """
    SELECT DISTINCT CAST(movie_id AS VARCHAR) AS movie_id, duration_minutes, genre_primary
    FROM movies_raw""")

_WATCH_SEEN = "session_id % 97 <> 0 AND user_id IS NOT NULL"
_SEARCH_SEEN = "search_id % 97 <> 0 AND user_id IS NOT NULL"

sql("json_roundtrip", f"""
    SELECT 'watch' AS event_type, strftime(event_ts, '{TS_FMT}') AS "current_timestamp",
           CAST(user_id AS VARCHAR) AS user_id, CAST(session_id AS VARCHAR) AS session_id,
           CAST(movie_id AS VARCHAR) AS movie_id, device_type, watch_duration_minutes,
           progress_percentage, action, quality, user_rating,
           NULL::VARCHAR AS search_id, NULL::VARCHAR AS search_query, NULL::INTEGER AS results_returned,
           NULL::INTEGER AS clicked_result_position, NULL::DOUBLE AS search_duration_seconds,
           NULL::VARCHAR AS had_typo, location_country,
           date_trunc('second', event_ts) AS ts, strftime(event_ts, '%Y%m%d%H') AS date_key
    FROM watch_events WHERE {_WATCH_SEEN}
    UNION ALL
    SELECT 'search', strftime(event_ts, '{TS_FMT}'), CAST(user_id AS VARCHAR), NULL, NULL, device_type,
           NULL, NULL, NULL, NULL, NULL,
           CAST(search_id AS VARCHAR), search_query, results_returned, clicked_result_position,
           search_duration_seconds, had_typo, location_country,
           date_trunc('second', event_ts), strftime(event_ts, '%Y%m%d%H')
    FROM search_events WHERE {_SEARCH_SEEN}""")

sql("normalize_watch", """
    SELECT CAST(session_id AS VARCHAR) AS session_id,
           CASE WHEN session_id % 37 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
           CAST(movie_id AS VARCHAR) AS movie_id, device_type,
           CASE WHEN session_id % 41 = 0 THEN 0.0 ELSE watch_duration_minutes END AS watch_duration_minutes,
           0.0::DOUBLE AS progress_percentage, action, quality,
           CASE WHEN movie_id % 7 IN (0, 1, 2) THEN NULL ELSE user_rating END AS user_rating,
           location_country, 'watch' AS event_type
    FROM watch_events""")

sql("normalize_search", """
    SELECT CAST(search_id AS VARCHAR) AS search_id,
           CASE WHEN search_id % 37 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
           search_query,
           CASE WHEN search_id % 41 = 0 THEN 0 ELSE results_returned END AS results_returned,
           clicked_result_position, search_duration_seconds, had_typo, device_type, location_country,
           'search' AS event_type
    FROM search_events""")

sql("fact_partition_roundtrip", 'SELECT date_key, COUNT(*) AS "rows" FROM fact_watch GROUP BY date_key')

# --- A: streaming --------------------------------------------------------

CTES["stream_watch"] = (f"""
    SELECT CAST(session_id AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS user_id,
           CAST(movie_id AS VARCHAR) AS movie_id, device_type, watch_duration_minutes,
           progress_percentage, action, quality, user_rating, location_country, date_key
    FROM fact_watch WHERE {_WATCH_SEEN}""", ("fact_watch",))
CTES["stream_search"] = (f"""
    SELECT CAST(search_id AS VARCHAR) AS search_id, CAST(user_id AS VARCHAR) AS user_id, search_query,
           results_returned, clicked_result_position, search_duration_seconds, had_typo,
           device_type, location_country, date_key
    FROM fact_search WHERE {_SEARCH_SEEN}""", ("fact_search",))

sql("stream_ingest_watch", "SELECT * FROM stream_watch")
sql("stream_ingest_search", "SELECT * FROM stream_search")
sql("stream_dual_write", " UNION ALL ".join(
    f"SELECT '{t}' AS target, '{tab}' AS \"table\", COUNT(*) AS \"rows\" FROM {src}"
    for t in ("fact", "serving")
    for tab, src in (("fact_watch_history", "stream_watch"), ("fact_search_logs", "stream_search"))))
sql("stream_restart_exactly_once", """
    SELECT 'fact_watch_history' AS "table", COUNT(*) AS "rows", COUNT(DISTINCT session_id) AS distinct_ids
    FROM stream_watch
    UNION ALL
    SELECT 'fact_search_logs', COUNT(*), COUNT(DISTINCT search_id) FROM stream_search""")
sql("stream_genre_counts", f"""
    SELECT m.genre_primary, COUNT(*) AS count
    FROM watch_events w LEFT JOIN dim_movies m ON w.movie_id = m.movie_id
    WHERE w.{_WATCH_SEEN.replace(' AND ', ' AND w.')} GROUP BY m.genre_primary""")
sql("stream_device_counts", f"""
    SELECT device_type, COUNT(*) AS count FROM watch_events WHERE {_WATCH_SEEN} GROUP BY device_type""")
SQL["stream_static_join"] = SQL["stream_genre_counts"]
_LINES = """COUNT(*) FILTER (event_type IN ('view', 'click', 'purchase', 'error', 'signup'))"""
_INPUT = f"CAST({_LINES} + COUNT(*) FILTER (event_id % 500 = 0) AS BIGINT)"
_COUNTED = f"""{_INPUT} AS records, CAST(COUNT(*) FILTER (event_id % 500 = 0) AS BIGINT) AS malformed,
           CAST(COUNT(*) FILTER (event_type IN ('view', 'click', 'purchase', 'error', 'signup')
                AND (event_id % 97 = 0 OR user_id IS NULL)) AS BIGINT) AS null_user"""
sql("stream_metrics", f"""
    SELECT 'ingest' AS query_name, {_INPUT} AS input_rows, {_COUNTED}, CAST(0 AS BIGINT) AS mistyped, true AS every_batch_once
    FROM events""")
sql("stream_rejects", f"""
    SELECT {_COUNTED}, CAST(COUNT(*) FILTER (event_id % 89 = 0
           AND event_type IN ('view', 'click', 'purchase', 'error', 'signup')) AS BIGINT) AS mistyped
    FROM events""")
sql("stream_speed_layer", f"""
    SELECT 'genre' AS layer, m.genre_primary AS value, COUNT(*) AS count
    FROM watch_events w LEFT JOIN dim_movies m ON w.movie_id = m.movie_id
    WHERE w.{_WATCH_SEEN.replace(' AND ', ' AND w.')} GROUP BY m.genre_primary
    UNION ALL
    SELECT layer, device_type, COUNT(*) FROM watch_events, (SELECT UNNEST(['device', 'facts']) AS layer) l
    WHERE {_WATCH_SEEN} GROUP BY layer, device_type""")
SQL["stream_batch_log"] = SQL["batch_event_stats"]
sql("report_replace", """
    SELECT device_type, COUNT(session_id) AS total_views FROM fact_watch GROUP BY device_type""")
sql("compact_fact", 'SELECT date_key, COUNT(*) AS "rows" FROM stream_watch GROUP BY date_key')
