"""Bind the driver's test tables to the reference's logical tables.

The reference reads clickstream JSON, movie/user CSVs, a dirty telemetry
CSV, e-commerce CSVs and social documents.  The test data is a TPC-H-like
star schema plus an ``events`` table, so every logical table is derived
are written as SQL in ``plans/oracle.py`` for the DuckDB check.

Everything here is lazy DataFrame code: Spark scans only the columns a
query needs and the derived tables grow with the inputs.  Every input row
is used; the ``key % m`` rules only decide which rows carry injected dirt,
duplicates or orphan keys (the edge cases the reference's generators
produce), never which rows are processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpulse.functions.columns import EVENT_TIME_FORMAT, hour_bucket

# Fixed values of the binding rule (shared with the SQL in plans/oracle.py).
DEVICES = ("TV", "Mobile", "Laptop", "Tablet")          # by event_id % 4
QUALITIES = ("SD", "HD", "4K")                           # by event_id % 3
WATCH_EVENT_TYPES = ("view", "click", "purchase")
SEARCH_EVENT_TYPES = ("error", "signup")
ORPHAN_SHIFT = 1_000_000_000                              # movie keys with k % 10 = 9 leave the dimension


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key, values) -> F.Column:
    expr = None
    for i, v in enumerate(values[:-1]):
        expr = F.when(key == i, v) if expr is None else expr.when(key == i, v)
    return expr.otherwise(values[-1])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the integer ``k`` pulled out of ``props``."""
    return read(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )


def user_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey -> nation name."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        read(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("c_custkey"), F.col("n_name").alias("location_country"))
    )


def _with_country(spark, sf_dir, ev: DataFrame) -> DataFrame:
    countries = user_country(spark, sf_dir)
    return ev.join(countries, ev["user_id"] == countries["c_custkey"], "left").drop("c_custkey")


def _movie_key() -> F.Column:
    """The movie key of an event; a tenth of the keys are orphans."""
    k = F.col("k").cast("long")
    return F.when(k % 10 == 9, k + ORPHAN_SHIFT).otherwise(k)


def watch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch events as the stream delivers them (before enrichment)."""
    ev = events(spark, sf_dir).filter(F.col("event_type").isin(*WATCH_EVENT_TYPES))
    ev = _with_country(spark, sf_dir, ev)
    return ev.select(
        F.col("event_id").alias("session_id"),
        "user_id",
        _movie_key().alias("movie_id"),
        _pick(F.col("event_id") % 4, DEVICES).alias("device_type"),
        F.col("value").alias("watch_duration_minutes"),
        F.lit(0.0).alias("progress_percentage"),
        F.when(F.col("event_type") == "click", "paused").otherwise(F.col("event_type")).alias("action"),
        _pick(F.col("event_id") % 3, QUALITIES).alias("quality"),
        (F.col("k") % 5 + 1).cast("int").alias("user_rating"),
        "location_country",
        hour_bucket("ts").alias("date_key"),
        F.col("ts").alias("event_ts"),
    )


def search_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).filter(F.col("event_type").isin(*SEARCH_EVENT_TYPES))
    ev = _with_country(spark, sf_dir, ev)
    return ev.select(
        F.col("event_id").alias("search_id"),
        "user_id",
        F.concat(F.lit("q"), F.col("k").cast("string")).alias("search_query"),
        (F.col("k") % 5).cast("int").alias("results_returned"),
        F.when(F.col("k") % 5 == 0, F.lit(None).cast("int"))
        .otherwise((F.col("k") % 3 + 1).cast("int"))
        .alias("clicked_result_position"),
        F.col("value").alias("search_duration_seconds"),
        F.when(F.col("event_type") == "error", "True").otherwise("False").alias("had_typo"),
        _pick(F.col("event_id") % 4, DEVICES).alias("device_type"),
        "location_country",
        hour_bucket("ts").alias("date_key"),
        F.col("ts").alias("event_ts"),
    )


def movies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movies.csv: all part rows, plus a re-release copy of every 25th key
    (duplicates)."""
    part = read(spark, sf_dir, "part")
    base = part.select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 2 == 0, "Movie").otherwise("TV Show").alias("content_type"),
        F.col("p_type").alias("genre_primary"),
        F.col("p_brand").alias("genre_secondary"),
        (F.col("p_partkey") % 45 + 1980).cast("int").alias("release_year"),
        (F.col("p_size") * 5.0).alias("duration_minutes"),
        (F.col("p_retailprice") / 100).alias("imdb_rating"),
        (F.col("p_partkey") % 7 == 0).alias("is_netflix_original"),
    )
    dups = base.filter(F.col("movie_id") % 25 == 0).withColumn(
        "title", F.concat("title", F.lit(" (re-release)"))
    )
    return base.unionByName(dups)


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users.csv: customer joined to nation, plus a moved copy of every
    25th customer (duplicate keys with different attributes)."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    base = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("user_id"),
        (key % 70 + 10).cast("double").alias("age"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("State-"), (F.col("c_nationkey") % 5).cast("string")).alias("state_province"),
        F.concat(F.lit("City-"), (key % 50).cast("string")).alias("city"),
        F.col("c_mktsegment").alias("subscription_plan"),
        (key % 10 != 0).alias("is_active"),
        F.col("c_acctbal").alias("monthly_spend"),
        _pick(key % 4, DEVICES).alias("primary_device"),
    )
    dups = base.filter(F.col("user_id") % 25 == 0).withColumn("city", F.concat("city", F.lit("-moved")))
    return base.unionByName(dups)


def telemetry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty telemetry CSV: events as text, dirtied by event_id
    (%40 = 1 blank user, 2 negative minutes, 3 corrupt time, 4 blank
    title) plus an exact copy of every row with event_id % 100 = 7."""
    ev = events(spark, sf_dir)
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    ev = ev.join(part, ev["k"] == part["p_partkey"], "left")
    dirt = F.col("event_id") % 40
    minutes = F.floor(F.col("value") * 10).cast("int")
    raw = ev.select(
        F.when(dirt == 3, "CORRUPT_TIMESTAMP")
        .otherwise(F.date_format("ts", EVENT_TIME_FORMAT))
        .alias("timestamp"),
        F.when(dirt == 1, "").otherwise(F.concat(F.lit("USER_"), F.col("user_id").cast("string"))).alias("user_id"),
        F.concat(F.lit("V"), F.col("k").cast("string")).alias("video_id"),
        F.col("p_type").alias("genre"),
        F.when(dirt == 4, "").otherwise(F.col("p_name")).alias("video_title"),
        F.when(dirt == 2, -minutes).otherwise(minutes).alias("watch_time_minutes"),
        _pick(F.col("event_id") % 4, DEVICES).alias("device_type"),
        F.col("event_id"),
    )
    copies = raw.filter(F.col("event_id") % 100 == 7)
    return raw.unionByName(copies).drop("event_id")


def clickstream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream values: every event as one JSON object (the producer's
    encoding), user nulled where event_id % 97 = 0, and one ``not json``
    line per 500 events.  One scan: the fields of the other kind are null,
    and JSON leaves null fields out."""
    from reelpulse.operators.events import to_json_value

    ev = _with_country(spark, sf_dir, events(spark, sf_dir))
    is_watch = F.col("event_type").isin(*WATCH_EVENT_TYPES)
    is_search = F.col("event_type").isin(*SEARCH_EVENT_TYPES)
    k, number = F.col("k"), F.col("event_id").cast("string")
    watch = {
        "session_id": number,
        "movie_id": _movie_key().cast("string"),
        "watch_duration_minutes": F.col("value"),
        "progress_percentage": F.lit(0.0),
        "action": F.when(F.col("event_type") == "click", "paused").otherwise(F.col("event_type")),
        "quality": _pick(F.col("event_id") % 3, QUALITIES),
        "user_rating": (k % 5 + 1).cast("int"),
    }
    search = {
        "search_id": number,
        "search_query": F.concat(F.lit("q"), k.cast("string")),
        "results_returned": (k % 5).cast("int"),
        "clicked_result_position": F.when(k % 5 != 0, (k % 3 + 1).cast("int")),
        "search_duration_seconds": F.col("value"),
        "had_typo": F.when(F.col("event_type") == "error", "True").otherwise("False"),
    }
    rows = ev.select(
        "event_id",
        F.when(is_watch, "watch").when(is_search, "search").alias("event_type"),
        F.col("ts").alias("current_timestamp"),
        F.when(F.col("event_id") % 97 != 0, F.col("user_id").cast("string")).alias("user_id"),
        _pick(F.col("event_id") % 4, DEVICES).alias("device_type"),
        "location_country",
        *[F.when(is_watch, c).alias(name) for name, c in watch.items()],
        *[F.when(is_search, c).alias(name) for name, c in search.items()],
    )
    known = F.col("event_type").isNotNull()
    lines = to_json_value(rows.withColumn("_known", known), keep=("event_id", "_known")).select(
        "event_id", F.explode(F.array_compact(F.array(
            F.when(F.col("_known"), F.col("value")),
            F.when(F.col("event_id") % 500 == 0, "not json")))).alias("value"))
    return lines


# --- e-commerce (lakehouse) ---------------------------------------------

def orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders.csv as text: order_id, customer_id, status, purchase time.
    Every 40th order carries an unparsable time; every 30th is repeated."""
    o = read(spark, sf_dir, "orders")
    base = o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(F.col("o_orderkey") % 40 == 0, "not a time")
        .otherwise(F.date_format("o_orderdate", EVENT_TIME_FORMAT))
        .alias("order_purchase_timestamp"),
        F.col("o_orderkey"),
    )
    dups = base.filter(F.col("o_orderkey") % 30 == 0).withColumn("order_status", F.lit("X"))
    return base.unionByName(dups).drop("o_orderkey")


def items_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items.csv as text: price = l_extendedprice, freight =
    price * tax rounded to cents; every 60th line has a bad price.
    (Text renderings of a double may differ between writers; the silver
    layer parses them back to the same double.)"""
    li = read(spark, sf_dir, "lineitem")
    bad = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 60
    price = F.col("l_extendedprice").cast("string")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(bad == 0, "abc").when(bad == 1, "-1.00").otherwise(price).alias("price"),
        F.round(F.col("l_extendedprice") * F.col("l_tax"), 2).cast("string").alias("freight_value"),
    )


def products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """products.csv as text: category = p_type, missing every 20th part."""
    p = read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 20 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_type"))
        .alias("product_category_name"),
        F.col("p_size").cast("string").alias("product_weight_g"),
    )


def reviews_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_reviews.csv as text: one review per order, score = first
    character of the priority, ``bad`` for every 50th order."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("review_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 50 == 0, "bad")
        .otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("review_score"),
    )


# --- social documents ----------------------------------------------------

def social_users_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SocialMediaUsersDataset.csv: customers with a birth date derived
    from the account balance; every 30th has an unparsable date."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    dob = F.date_format(
        F.date_add(F.to_date(F.lit("1950-01-01")), (key * 97 % 18000).cast("int")), "yyyy-MM-dd"
    )
    return cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.cast("int").alias("UserID"),
        F.col("c_name").alias("Name"),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("Gender"),
        F.when(key % 30 == 0, "unknown").otherwise(dob).alias("DOB"),
        F.concat(F.lit("City-"), (key % 50).cast("string")).alias("City"),
        F.col("n_name").alias("Country"),
    )


def social_posts_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facebook_data_txt.csv: documents as posts (category = source)."""
    d = read(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("post_id"),
        F.lit("2024-01-01 00:00:00").alias("timestamp"),
        F.col("source").alias("category"),
        F.when(F.col("n_chars") % 3 == 0, "positive")
        .when(F.col("n_chars") % 3 == 1, "neutral")
        .otherwise("negative")
        .alias("sentiment"),
        F.col("lang").alias("language"),
        (F.col("n_chars") % 1000).cast("string").alias("likes"),
        (F.col("n_chars") % 100).cast("string").alias("comments"),
        (F.col("n_chars") % 10).cast("string").alias("shares"),
        (F.col("doc_id") % 2).cast("string").alias("is_spam"),
    )


def social_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feeds: events as user actions on posts."""
    ev = events(spark, sf_dir)
    return ev.select(
        F.col("event_id").alias("feed_id"),
        F.col("user_id"),
        F.col("k").cast("long").alias("post_id"),
        F.col("event_type").alias("action"),
        F.col("ts").alias("timestamp"),
    )


# --- raw producer CSVs (before normalising) -------------------------------

def watch_history_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """watch_history.csv as text, with empty users (every 37th session),
    empty durations (every 41st) and ratings ``4.0`` / ``-1`` / empty."""
    w = watch_events(spark, sf_dir)
    sid = F.col("session_id")
    rating = F.col("movie_id") % 7
    return w.select(
        sid.cast("string").alias("session_id"),
        F.when(sid % 37 == 0, "").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.col("movie_id").cast("string").alias("movie_id"),
        "device_type",
        F.when(sid % 41 == 0, "").otherwise(F.col("watch_duration_minutes").cast("string")).alias("watch_duration_minutes"),
        F.lit("").alias("progress_percentage"),
        "action", "quality",
        F.when(rating == 0, "4.0").when(rating == 1, "-1").when(rating == 2, "")
        .otherwise(F.col("user_rating").cast("string")).alias("user_rating"),
        "location_country",
    )


def search_logs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """search_logs.csv as text, with empty users and empty counts."""
    s = search_events(spark, sf_dir)
    sid = F.col("search_id")
    return s.select(
        sid.cast("string").alias("search_id"),
        F.when(sid % 37 == 0, "").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        "search_query",
        F.when(sid % 41 == 0, "").otherwise(F.col("results_returned").cast("string")).alias("results_returned"),
        F.coalesce(F.col("clicked_result_position").cast("string"), F.lit("")).alias("clicked_result_position"),
        F.col("search_duration_seconds").cast("string").alias("search_duration_seconds"),
        "had_typo", "device_type", "location_country",
    )


def mistyped_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clickstream_json`` with a text in a number field of every event whose id
    is divisible by 89."""
    value = F.regexp_replace("value", r'"(user_rating|results_returned)":\d+', r'"$1":"many"')
    return clickstream_json(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 89 == 0, value).otherwise(F.col("value")))
