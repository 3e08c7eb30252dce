"""Dirty telemetry: cleaning, the one-pass cleaning funnel, top-k reports
and anomaly flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.functions.columns import is_blank, parse_time

ANOMALY_MINUTES = 1440  # one sitting of a full day or more

FUNNEL_STEPS = ("raw", "deduplicated", "valid_user_title", "positive_minutes", "valid_timestamp")


def _info_ok():
    return ~is_blank("user_id") & ~is_blank("video_title")


def clean_telemetry(raw: DataFrame) -> DataFrame:
    """Exact-duplicate removal, then: user and title present, minutes > 0,
    timestamp parses (unparsable text -> null -> dropped, trap T2)."""
    return (
        raw.dropDuplicates()
        .filter(_info_ok())
        .filter(F.col("watch_time_minutes") > 0)
        .withColumn("timestamp", parse_time("timestamp"))
        .dropna(subset=["timestamp"])
    )


def cleaning_funnel(raw: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, rows removed by it, and the
    share of the raw input - from one scan.

    ``groupBy(all columns).count()`` yields the raw total (sum of counts)
    and the deduplicated total (number of groups) together; the later
    steps are cumulative flags counted in the same aggregate.  Partial
    aggregation keeps a heavily duplicated row from landing in one task.
    """
    rows = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_n"))
    info = _info_ok()
    minutes = info & (F.col("watch_time_minutes") > 0)
    valid = minutes & parse_time("timestamp").isNotNull()
    totals = rows.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("raw"),
        F.count(F.lit(1)).alias("deduplicated"),
        F.count(F.when(info, 1)).alias("valid_user_title"),
        F.count(F.when(minutes, 1)).alias("positive_minutes"),
        F.count(F.when(valid, 1)).alias("valid_timestamp"),
    )
    steps = []
    for i, step in enumerate(FUNNEL_STEPS):
        prev = F.col(FUNNEL_STEPS[i - 1]) if i else F.col(step)
        steps.append(F.struct(
            F.lit(i).alias("step_no"),
            F.lit(step).alias("step"),
            F.col(step).alias("rows"),
            (prev - F.col(step)).alias("removed"),
            F.round(F.try_divide(F.col(step).cast("double") * 100.0, F.col("raw").cast("double")), 2).alias("pct_of_raw"),
        ))
    return totals.select(F.explode(F.array(*steps)).alias("s")).select("s.*")


def top_users(clean: DataFrame, n: int = 5) -> DataFrame:
    return (
        clean.groupBy("user_id")
        .agg(F.sum("watch_time_minutes").alias("Total_Minutes"))
        .orderBy(F.desc("Total_Minutes"), F.asc("user_id"))
        .limit(n)
    )


def _most_frequent(clean: DataFrame, key, name: str, count: str, n: int) -> DataFrame:
    """The n values of ``key`` with most rows, ties by value."""
    counted = clean.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias(count))
    return counted.orderBy(F.desc(count), F.asc(name)).limit(n)


def trending_videos(clean: DataFrame, n: int = 5) -> DataFrame:
    return _most_frequent(clean, F.col("video_title"), "video_title", "Views", n)


def activity_by_hour(clean: DataFrame, n: int = 5) -> DataFrame:
    return _most_frequent(clean, F.hour("timestamp"), "hour", "count", n)


def genre_watch_stats(clean: DataFrame) -> DataFrame:
    m = "watch_time_minutes"
    return clean.groupBy("genre").agg(
        F.sum(m).alias("total"),
        F.avg(m).alias("average"),
        F.min(m).alias("shortest"),
        F.max(m).alias("longest"),
    )


ANOMALY_COLUMNS = ["timestamp", "user_id", "video_title", "watch_time_minutes", "device_type"]


def anomalies(clean: DataFrame, min_minutes: int = ANOMALY_MINUTES, user_id: str | None = None,
              n: int | None = None) -> DataFrame:
    """Sessions of ``min_minutes`` or more; optionally one user's, and
    optionally only the ``n`` longest (ties broken by the other columns)."""
    out = clean.filter(F.col("watch_time_minutes") >= min_minutes)
    if user_id is not None:
        out = out.filter(F.col("user_id") == user_id)
    out = out.select(*ANOMALY_COLUMNS)
    if n is not None:
        out = out.orderBy(
            F.desc("watch_time_minutes"), *[F.asc(c) for c in ANOMALY_COLUMNS if c != "watch_time_minutes"]
        ).limit(n)
    return out
