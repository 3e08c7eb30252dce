import json

from pyspark.sql import functions as F

from reelpulse import schemas
from reelpulse.operators import events as ev


def _values(spark, lines):
    return spark.createDataFrame([(l,) for l in lines], "value string")


def test_parse_events_trap_t3(spark):
    lines = [
        "not json",
        json.dumps({"event_type": "watch", "user_id": None, "current_timestamp": "2024-01-01 10:00:00"}),
        json.dumps({"event_type": "watch", "user_id": "u1", "user_rating": "abc",
                    "current_timestamp": "2024-01-01 10:00:00"}),
        json.dumps({"event_type": "watch", "user_id": "u2", "user_rating": 4.5,
                    "current_timestamp": "2024-01-01 22:30:00", "watch_duration_minutes": 12.5}),
        json.dumps({"event_type": "click", "user_id": "u3", "current_timestamp": "bad time"}),
    ]
    out = ev.parse_events(_values(spark, lines))
    got = {r["user_id"]: r for r in out.collect()}
    assert set(got) == {"u1", "u2", "u3"}          # malformed + null user dropped
    assert got["u1"]["user_rating"] is None         # bad field nulls only itself
    assert got["u2"]["user_rating"] is None and got["u2"]["watch_duration_minutes"] == 12.5
    assert got["u2"]["date_key"] == "2024010122"
    assert got["u3"]["ts"] is None and got["u3"]["date_key"] is None
    # unknown kinds are dropped by routing
    assert ev.route(out, "watch").count() == 2 and ev.route(out, "search").count() == 0


def test_json_roundtrip_formats_times(spark):
    df = spark.createDataFrame([("watch", "u1", "2024-01-02 03:04:05")], "event_type string, user_id string, t string")
    df = df.select("event_type", "user_id", F.to_timestamp("t").alias("current_timestamp"))
    value = ev.to_json_value(df).first()[0]
    assert '"current_timestamp":"2024-01-02 03:04:05"' in value      # no ISO 'T'
    back = ev.parse_events(_values(spark, [value])).first()
    assert back["date_key"] == "2024010203"


def test_watch_facts_unknown_movie_and_lengths(spark):
    watch = spark.createDataFrame(
        [("s1", "u", "m1", 30.0), ("s2", "u", "m404", 30.0), ("s3", "u", "m0", 30.0),
         ("s4", "u", "mnull", 30.0), ("s5", "u", "m1", None), ("s6", "u", "m1", 200.0)],
        "session_id string, user_id string, movie_id string, watch_duration_minutes double",
    )
    for c in ["device_type", "action", "quality", "location_country", "date_key"]:
        watch = watch.withColumn(c, F.lit("x"))
    watch = watch.withColumn("user_rating", F.lit(None).cast("int"))
    movies = spark.createDataFrame(
        [(1, 60.0), (0, 0.0), (None, None)], "movie_id long, duration_minutes double"
    ).withColumn("movie_id", F.when(F.col("duration_minutes") == 60.0, "m1")
                 .when(F.col("duration_minutes") == 0.0, "m0").otherwise("mnull"))
    out = {r["session_id"]: r["progress_percentage"] for r in ev.watch_facts(watch, movies).collect()}
    assert out == {"s1": 50.0, "s2": 0.0, "s3": 0.0, "s4": 0.0, "s5": None, "s6": 100.0}
    assert ev.watch_facts(watch, movies).columns == schemas.WATCH_FACT_COLUMNS


def test_normalize_watch_trap_t13(spark):
    raw = spark.createDataFrame(
        [("s1", "", "m", "TV", "", "", "paused", "HD", "4.0", ""),
         ("s2", "u2", "m", "TV", "12.5", "", "paused", "HD", "5", "VN")],
        ",".join(f"{c} string" for c in schemas.RAW_WATCH_COLUMNS),
    )
    out = {r["session_id"]: r for r in ev.normalize_watch(raw).collect()}
    assert out["s1"]["user_id"] is None and out["s1"]["watch_duration_minutes"] == 0.0
    assert out["s1"]["user_rating"] is None and out["s1"]["location_country"] == ""   # empty stays empty
    assert out["s2"]["user_rating"] == 5 and out["s2"]["progress_percentage"] == 0.0
    # a missing country column is defaulted
    no_country = ev.normalize_watch(raw.drop("location_country"))
    assert {r["location_country"] for r in no_country.collect()} == {"Unknown"}


def test_normalize_search_defaults(spark):
    raw = spark.createDataFrame(
        [("q1", "u", "abc", "", "", "", "True", "TV", "VN")],
        ",".join(f"{c} string" for c in schemas.RAW_SEARCH_COLUMNS),
    )
    r = ev.normalize_search(raw).first()
    assert (r["results_returned"], r["clicked_result_position"], r["search_duration_seconds"]) == (0, None, 0.0)
    r = ev.normalize_search(raw.drop("had_typo")).first()
    assert r["had_typo"] == "False"
