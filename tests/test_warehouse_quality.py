from pyspark.sql import functions as F

from reelpulse.operators import quality as dq
from reelpulse.operators import warehouse as wh

from conftest import rows


def test_dedupe_by_key_deterministic_and_null_group(spark):
    df = spark.createDataFrame(
        [("u1", "b", 2), ("u1", "a", 9), ("u1", "a", 1), (None, "z", 1), (None, "y", 1), ("u2", None, 5), ("u2", "c", 5)],
        "k string, v string, n int",
    )
    for shuffled in (df, df.repartition(5), df.orderBy(F.rand(7))):
        assert rows(wh.dedupe_by_key(shuffled, "k")) == [("u1", "a", 1), ("u2", None, 5), (None, "y", 1)]


def test_dim_users_age_group_and_dedup(spark):
    raw = spark.createDataFrame(
        [("1", 30.0, "F", "VN", "s", "c", "basic", True, 1.0, "TV"),
         ("1", 30.0, "F", "VN", "s", "c2", "basic", True, 1.0, "TV"),
         ("2", None, "M", "VN", "s", "c", "basic", False, 2.0, "TV")],
        "user_id string, age double, gender string, country string, state_province string, city string, "
        "subscription_plan string, is_active boolean, monthly_spend double, primary_device string",
    )
    out = {r["user_id"]: r for r in wh.dim_users(raw).collect()}
    assert len(out) == 2 and out["1"]["city"] == "c" and out["2"]["age_group"] == "Senior"


def test_dim_date_from_fact_keys(spark):
    watch = spark.createDataFrame([("2024011322",), ("2024011405",), (None,)], "date_key string")
    search = spark.createDataFrame([("2024011322",), ("2024011504",)], "date_key string")
    d = {r["date_key"]: r for r in wh.dim_date(watch, search).collect()}
    assert len(d) == 4                                  # distinct, one null row kept (T18)
    sat = d["2024011322"]
    assert (sat["hour"], sat["day"], sat["month"], sat["year"]) == (22, 13, 1, 2024)
    assert (sat["day_of_week"], sat["day_name"], sat["is_weekend"], sat["is_night"]) == (7, "Sat", True, True)
    assert d["2024011405"]["is_night"] is False and d["2024011504"]["is_night"] is True
    assert d[None]["is_night"] is False and d[None]["is_weekend"] is False


def test_fact_date_key_read_back_as_text(spark, tmp_path):
    from reelpulse import schemas
    from reelpulse.sources import io

    df = spark.createDataFrame([(str(i), "u", "m", "TV", 1.0, 2.0, "a", "HD", 1, "VN", "2024011509") for i in range(3)],
                               schemas.WATCH_FACT)
    io.append_fact(df, str(tmp_path / "f"), 0)
    io.append_fact(df, str(tmp_path / "f"), 0)              # replay of the same batch
    back = io.read_fact(spark, str(tmp_path / "f"), "watch")
    assert dict(back.dtypes)["date_key"] == "string" and back.count() == 3
    # partition discovery alone turns the key into an int (trap T1)
    assert dict(spark.read.parquet(str(tmp_path / "f")).dtypes)["date_key"] == "int"


def test_load_static_movies_fallback(spark, tmp_path):
    csv = tmp_path / "movies_csv"
    spark.createDataFrame(
        [("m1", "t", "Movie", "Drama", "x", 2000, 90.0, 7.0, True),
         ("m1", "t (again)", "Movie", "Drama", "x", 2000, 90.0, 7.0, True)],
        "movie_id string, title string, content_type string, genre_primary string, genre_secondary string, "
        "release_year int, duration_minutes double, imdb_rating double, is_netflix_original boolean",
    ).write.option("header", True).csv(str(csv))
    out = wh.load_static_movies(spark, str(tmp_path / "missing_parquet"), str(csv))
    assert rows(out) == [("m1", 90.0, "Drama")]             # deduplicated (T9)


def test_quality_reports(spark):
    dim = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    assert rows(dq.null_keys({"d": (dim, "k")})) == [("d", "k", 2)]
    assert rows(dq.duplicate_keys({"d": (dim, "k")})) == [("d", "k", 2)]
    rep = dq.dimension_report({"d": (dim, "k"), "ok": (spark.range(3).withColumnRenamed("id", "k"), "k")})
    assert rows(rep) == [("d", "k", 2, 2, False), ("ok", "k", 0, 0, True)]
    assert rows(dq.row_counts({"d": dim})) == [("d", 5)]


def test_ri_null_fk_is_orphan_trap_t6(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,), (None,)], "fk long")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "pk long")
    assert rows(dq.orphans(fact, dim, "fk", "pk")) == [(3,), (None,)]
    rep = dq.ri_report([("f", fact, "fk", "d", dim, "pk")]).first()
    assert (rep["null_fk"], rep["unmatched_fk"], rep["orphans"]) == (1, 1, 2)


def test_views_and_written_counts(spark, tmp_path):
    from reelpulse.sources import io

    df = spark.createDataFrame([("TV", "s1"), ("TV", "s2"), ("Mobile", "s3")], "device_type string, session_id string")
    wh.register_views(spark, {"fact_watch_t": df})
    got = spark.sql("SELECT device_type, COUNT(session_id) AS n FROM fact_watch_t GROUP BY device_type")
    assert rows(got) == [("Mobile", 1), ("TV", 2)]
    wh.register_global_views(spark, {"fact_watch_g": df})
    assert spark.newSession().sql("SELECT COUNT(*) FROM global_temp.fact_watch_g").first()[0] == 3
    io.save_dimension(df, str(tmp_path / "dim"))
    assert io.verify_written(spark, str(tmp_path / "dim")) == 3


from hypothesis import given, settings, strategies as hs  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(hs.lists(hs.tuples(hs.sampled_from(["a", "b", "c", None]), hs.integers(0, 3), hs.one_of(hs.none(), hs.text("xy", max_size=2))),
                max_size=30))
def test_dedupe_idempotent_and_order_free(spark, data):
    df = spark.createDataFrame(data, "k string, n int, v string")
    once = wh.dedupe_by_key(df, "k")
    assert rows(wh.dedupe_by_key(once, "k")) == rows(once)                 # idempotent
    assert rows(wh.dedupe_by_key(df.orderBy(F.rand(3)), "k")) == rows(once)
    assert once.count() == df.select("k").distinct().count()
