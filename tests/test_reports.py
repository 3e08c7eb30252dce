"""Report operators against a hand-made star schema, checked with plain
Spark SQL written the way the reference writes it (row-level joins)."""

import pytest
from pyspark.sql import functions as F

from reelpulse.operators import reports as rp

from conftest import plan_text, rows


@pytest.fixture(scope="module")
def star(spark):
    watch = spark.createDataFrame(
        [("s1", "u1", 1, "TV", 10.0, 9.99, "paused", "HD", 1, "VN", "2024011321"),
         ("s2", "u1", 1, "TV", 20.0, 10.0, "paused", "HD", 2, "VN", "2024011322"),
         ("s3", "u2", 2, "Mobile", 30.0, None, "paused", "4K", 3, "US", "2024011304"),
         ("s4", "u3", 3, "Mobile", 40.0, 100.0, "view", "SD", 4, "US", "2024011305"),
         ("s5", "u3", 9, "Laptop", 50.0, 5.0, "paused", "SD", 5, "US", "2024011322"),
         (None, "u4", 2, "Laptop", 60.0, 1.0, "paused", "SD", 5, "US", None)],
        "session_id string, user_id string, movie_id long, device_type string, watch_duration_minutes double, "
        "progress_percentage double, action string, quality string, user_rating int, location_country string, "
        "date_key string",
    )
    movies = spark.createDataFrame(
        [(1, "Drama", 7.0), (2, "Comedy", 6.005), (3, "Drama", 8.0)],
        "movie_id long, genre_primary string, imdb_rating double",
    )
    from reelpulse.operators.warehouse import dim_date
    dates = dim_date(watch, watch.limit(0))
    for name, df in (("fact_watch", watch), ("dim_movies", movies), ("dim_date", dates)):
        df.createOrReplaceTempView(name)
    return watch, movies, dates


def test_top_devices(spark, star):
    watch, _, _ = star
    assert rows(rp.top_devices(watch)) == [("Laptop", 1), ("Mobile", 2), ("TV", 2)]
    assert [r[0] for r in rp.top_devices(watch).collect()] == ["Mobile", "TV", "Laptop"]  # tiebreak by key


def test_genre_popularity_equals_row_level_sql(spark, star):
    watch, movies, _ = star
    expected = spark.sql("""
        SELECT m.genre_primary, COUNT(f.session_id) AS watch_count,
               ROUND(AVG(CAST(m.imdb_rating AS DECIMAL(38,12))), 2) AS r,
               ROUND(AVG(CAST(f.watch_duration_minutes AS DECIMAL(38,12))), 2) AS w
        FROM fact_watch f JOIN dim_movies m ON f.movie_id = m.movie_id GROUP BY m.genre_primary""")
    exp = [(g, c, float(r), float(w)) for g, c, r, w in rows(expected)]
    assert rows(rp.genre_popularity(watch, movies)) == exp


def test_peak_hours_distinct_users(spark, star):
    watch, _, dates = star
    got = {r["hour"]: r for r in rp.peak_hours(watch, dates).collect()}
    assert got[22]["active_users"] == 2 and got[22]["avg_watch_duration"] == 35.0
    assert None not in got                       # null date_key dropped by the inner join (T17)


def test_binge_genres_night_hours(spark, star):
    watch, movies, dates = star
    got = rows(rp.binge_genres(watch, dates, movies))
    # hours 22 and 4 are night, 21 and 5 are not; movie 9 has no dimension row
    assert got == [("Comedy", 30.0, None), ("Drama", 20.0, 10.0)]


def test_churn_risk_predicate_edges(spark, star):
    watch, _, _ = star
    got = rows(rp.churn_risk(watch))
    # 9.99 qualifies, 10.0 and null progress do not, 'view' is not an exit;
    # a null session is averaged but not counted as a drop event
    assert got == [("Laptop", "US", "SD", 1, 3.0, 55.0), ("TV", "VN", "HD", 1, 9.99, 10.0)]


def test_failed_searches_ties_at_limit(spark):
    search = spark.createDataFrame(
        [(f"s{i}", f"q{i % 12}", 0, "False") for i in range(24)] + [("x", "q0", 3, "False")],
        "search_id string, search_query string, results_returned int, had_typo string",
    )
    out = [r["search_query"] for r in rp.failed_searches(search, 10).collect()]
    assert out == sorted(f"q{i}" for i in range(12))[:10]         # all tie at 2, keys break ties


def test_binge_plan_prunes_fact_partitions(spark, tmp_path):
    """With an hour-partitioned fact, the night filter reaches the fact
    scan as a dynamic partition-pruning filter."""
    fact = spark.createDataFrame(
        [(f"s{i}", i % 5, 10.0, 50.0, f"20240113{h:02d}") for i, h in enumerate(range(24))],
        "session_id string, movie_id long, watch_duration_minutes double, progress_percentage double, date_key string",
    )
    fact.write.partitionBy("date_key").parquet(str(tmp_path / "fact"))
    stored = spark.read.schema(fact.schema).parquet(str(tmp_path / "fact"))
    from reelpulse.operators.warehouse import dim_date
    dim_date(fact, fact.limit(0)).write.parquet(str(tmp_path / "dim_date"))
    dates = spark.read.parquet(str(tmp_path / "dim_date"))
    movies = spark.createDataFrame([(i, f"g{i}") for i in range(5)], "movie_id long, genre_primary string")
    assert "dynamicpruning" in plan_text(rp.binge_genres(stored, dates, movies)).lower()
