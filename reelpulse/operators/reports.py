"""The six BI reports over the star schema.

Shape of every plan: aggregate the fact as early as possible (partial
aggregation runs map-side, so hot keys collapse before the shuffle), and
join dimensions either after the fact has been reduced to one row per
dimension key, or against a dimension whose size is bounded (dim_date is
one row per hour).  Ties in ordered output are broken by the group keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.functions.columns import (
    NIGHT_END_HOUR,
    NIGHT_START_HOUR,
    rounded,
)


def top_devices(watch: DataFrame) -> DataFrame:
    return (
        watch.groupBy("device_type")
        .agg(F.count("session_id").alias("total_views"))
        .orderBy(F.desc("total_views"), F.asc("device_type"))
    )


def genre_popularity(watch: DataFrame, movies: DataFrame) -> DataFrame:
    """Inner fact-movies join, per genre: views, mean rating, mean minutes.

    The fact is first reduced to one row per movie_id (sums and counts), so
    the join touches at most one row per movie instead of every watch event;
    the per-genre means are rebuilt from those partial sums.
    """
    per_movie = watch.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("session_id").alias("_views"),
        F.sum("watch_duration_minutes").alias("_dur_sum"),
        F.count("watch_duration_minutes").alias("_dur_n"),
    )
    m = movies.select("movie_id", "genre_primary", "imdb_rating")
    rating = F.col("imdb_rating")
    joined = per_movie.join(m, "movie_id")
    return (
        joined.groupBy("genre_primary")
        .agg(
            F.sum("_views").alias("watch_count"),
            F.sum(rating * F.col("_rows")).alias("_r_sum"),
            F.sum(F.when(rating.isNotNull(), F.col("_rows"))).alias("_r_n"),
            F.sum("_dur_sum").alias("_d_sum"),
            F.sum("_dur_n").alias("_d_n"),
        )
        .select(
            "genre_primary",
            "watch_count",
            rounded(F.try_divide("_r_sum", "_r_n")).alias("avg_imdb_rating"),
            rounded(F.try_divide("_d_sum", "_d_n")).alias("avg_watch_minutes"),
        )
        .orderBy(F.desc("watch_count"), F.asc("genre_primary"))
    )


def peak_hours(watch: DataFrame, dates: DataFrame) -> DataFrame:
    """Per hour of day: distinct users (exact), mean progress and minutes.

    dim_date is bounded by the number of hours in the time span, so it is
    the build side of a hash join; the distinct count is planned by Spark
    as a two-level aggregate keyed by (hour, user) - no single hot task.
    """
    d = dates.select("date_key", "hour")
    f = watch.select("date_key", "user_id", "progress_percentage", "watch_duration_minutes")
    return (
        f.join(d, "date_key")
        .groupBy("hour")
        .agg(
            F.countDistinct("user_id").alias("active_users"),
            rounded(F.avg("progress_percentage")).alias("avg_progress_pct"),
            rounded(F.avg("watch_duration_minutes")).alias("avg_watch_duration"),
        )
        .orderBy(F.desc("active_users"), F.asc("hour"))
    )


def night_filter(dates: DataFrame, night=(NIGHT_START_HOUR, NIGHT_END_HOUR)) -> DataFrame:
    """Night hours as a range predicate on ``hour`` - for the default window
    the same rows as ``is_night`` - which lets dynamic partition pruning skip
    day-time ``date_key`` partitions of a partitioned fact table.  A window
    whose start lies after its end wraps midnight."""
    start, end = night
    after, before = F.col("hour") >= start, F.col("hour") <= end
    return dates.filter(after & before if start <= end else after | before)


def binge_genres(watch: DataFrame, dates: DataFrame, movies: DataFrame, night=(NIGHT_START_HOUR, NIGHT_END_HOUR)) -> DataFrame:
    """Night-time viewing per genre: total minutes and mean progress."""
    nights = night_filter(dates, night).select("date_key")
    f = watch.select("date_key", "movie_id", "watch_duration_minutes", "progress_percentage")
    per_movie = (
        f.join(nights, "date_key")
        .groupBy("movie_id")
        .agg(
            F.sum("watch_duration_minutes").alias("_dur"),
            F.sum("progress_percentage").alias("_p_sum"),
            F.count("progress_percentage").alias("_p_n"),
        )
    )
    m = movies.select("movie_id", "genre_primary")
    return (
        per_movie.join(m, "movie_id")
        .groupBy("genre_primary")
        .agg(F.sum("_dur").alias("_dur"), F.sum("_p_sum").alias("_p_sum"), F.sum("_p_n").alias("_p_n"))
        .select(
            "genre_primary",
            rounded("_dur").alias("total_watch_duration"),
            rounded(F.try_divide("_p_sum", "_p_n")).alias("avg_progress_pct"),
        )
        .orderBy(F.desc("total_watch_duration"), F.asc("genre_primary"))
    )


def churn_risk(watch: DataFrame, max_progress: float = 10.0, action: str = "paused") -> DataFrame:
    """Early exits (paused below ``max_progress`` percent) per device,
    country and quality."""
    keys = ["device_type", "location_country", "quality"]
    return (
        watch.filter((F.col("progress_percentage") < max_progress) & (F.col("action") == action))
        .groupBy(*keys)
        .agg(
            F.count("session_id").alias("drop_events"),
            F.avg("progress_percentage").alias("avg_progress_at_drop"),
            F.avg("watch_duration_minutes").alias("avg_watch_duration"),
        )
        .orderBy(F.desc("drop_events"), *[F.asc(k) for k in keys])
    )


def failed_searches(search: DataFrame, n: int = 10) -> DataFrame:
    """Top-n zero-result queries (with the typo flag); the limit is the
    report itself, planned as TakeOrderedAndProject."""
    return (
        search.filter(F.col("results_returned") == 0)
        .groupBy("search_query", "had_typo")
        .agg(F.count("search_id").alias("failed_count"))
        .orderBy(F.desc("failed_count"), F.asc("search_query"), F.asc("had_typo"))
        .limit(n)
    )
