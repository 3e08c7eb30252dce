import datetime as dt

from pyspark.sql import functions as F

from reelpulse.functions import columns as C


def test_parse_time_bad_text_is_null(spark):
    # ANSI is on in Spark 4: a plain to_timestamp would raise (trap T2)
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("CORRUPT_TIMESTAMP",), ("09/06/2026",), ("",), (None,)], "t string")
    out = [r[0] for r in df.select(C.parse_time("t")).collect()]
    assert out[0] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert out[1:] == [None, None, None, None]


def test_hour_bucket(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 9, 59, 59),)], "ts timestamp")
    assert df.select(C.hour_bucket("ts")).first()[0] == "2024011509"


def test_capped_progress_trap_t15(spark):
    df = spark.createDataFrame(
        [(30.0, 60.0), (90.0, 60.0), (None, 60.0), (30.0, 0.0), (30.0, None), (-6.0, 60.0), (1.0, 3.0)],
        "w double, d double",
    )
    out = [r[0] for r in df.select(C.capped_progress("w", "d")).collect()]
    # null watch time stays null (least() would give 100); no length -> 0.0;
    # negatives are not floored; 2 decimals, half up
    assert out == [50.0, 100.0, None, 0.0, 0.0, -10.0, 33.33]


def test_age_group_edges(spark):
    ages = [17.0, 18.0, 35.0, 35.5, 36.0, 55.0, 56.0, None, -3.0]
    df = spark.createDataFrame([(a,) for a in ages], "age double")
    out = [r[0] for r in df.select(C.age_group("age")).collect()]
    assert out == ["Children", "Young Adults", "Young Adults", "Senior", "Middle-aged",
                   "Middle-aged", "Senior", "Senior", "Children"]


def test_digits_int(spark):
    df = spark.createDataFrame([("4",), ("4.0",), ("-1",), ("",), (None,), ("12",)], "r string")
    assert [r[0] for r in df.select(C.digits_int("r")).collect()] == [4, None, None, None, None, 12]


def test_night_and_weekend_flags_null_is_false(spark):
    df = spark.createDataFrame([(21,), (22,), (4,), (5,), (None,)], "h int")
    assert [r[0] for r in df.select(C.is_night_hour("h")).collect()] == [False, True, True, False, False]
    df = spark.createDataFrame([(1,), (2,), (7,), (None,)], "d int")
    assert [r[0] for r in df.select(C.is_weekend_day("d")).collect()] == [True, False, True, False]


def test_years_since_bad_date(spark):
    df = spark.createDataFrame([("1990-12-31",), ("not a date",), (None,)], "dob string")
    out = [r[0] for r in df.select(C.years_since("dob", F.lit("2024-01-01").cast("date"))).collect()]
    assert out == [34, None, None]


def test_rounded_mean_is_order_independent(spark):
    vals = [0.1] * 10 + [1e6, -1e6] + [0.2] * 5
    a = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").coalesce(1)
    assert a.agg(C.rounded(F.avg("x"))).first()[0] == b.agg(C.rounded(F.avg("x"))).first()[0]


def test_reports_carry_non_finite_and_huge_values(spark):
    import math

    from reelpulse.operators import reports as rp

    def churn(*progress):
        df = spark.createDataFrame([("TV", "x", "HD", "s", p, "paused", p) for p in progress],
                                   "device_type string, location_country string, quality string, session_id string, "
                                   "progress_percentage double, action string, watch_duration_minutes double")
        return rp.churn_risk(df, max_progress=math.inf).first()

    assert math.isnan(rp.churn_risk(spark.createDataFrame(
        [("TV", "x", "HD", "s", 1.0, "paused", v) for v in (1.0, 3.0, float("nan"))],
        "device_type string, location_country string, quality string, session_id string, "
        "progress_percentage double, action string, watch_duration_minutes double")).first()["avg_watch_duration"])
    assert churn(1.0, -math.inf)["avg_progress_at_drop"] == -math.inf
    assert churn(1e27, 1e27)["avg_progress_at_drop"] == 1e27
