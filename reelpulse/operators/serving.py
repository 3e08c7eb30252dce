"""Serving-layer rollups: batch + speed merge, KPI header and segment
views, as DataFrame operators instead of driver-side pandas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.schemas import FEATURE_COLUMNS


def merge_batch_speed(batch: DataFrame, speed: DataFrame, key: str, batch_value: str,
                      speed_value: str = "count", out: str = "total") -> DataFrame:
    """Union the batch report and the live counts by key and add them up.

    Both value columns are renamed to ``out`` before the union, so a key
    present in only one layer keeps its value (the positional pick of the
    original dashboard added nothing for stream rows - trap T5).  Null
    keys are dropped, as a pandas group-by does.  A merge with an empty
    layer returns the other layer unchanged.
    """
    b = batch.select(F.col(key), F.col(batch_value).cast("long").alias(out))
    s = speed.select(F.col(key), F.col(speed_value).cast("long").alias(out))
    return (
        b.unionByName(s)
        .filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(out).alias(out))
        .orderBy(F.desc(out), F.asc(key))
    )


def kpi_summary(segments: DataFrame) -> DataFrame:
    return segments.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.avg("total_duration_minutes").alias("avg_duration"),
        F.avg("avg_progress_percentage").alias("avg_progress"),
    )


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment_name").agg(F.count(F.lit(1)).alias("count")).orderBy("segment_name")


def segment_profile(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment_name").agg(*[F.avg(c).alias(c) for c in FEATURE_COLUMNS])


def segment_names(segments: DataFrame) -> DataFrame:
    return segments.select("segment_name").distinct().orderBy("segment_name")


def segment_lookup(segments: DataFrame, name: str | None = None) -> DataFrame:
    """All users, or the users of one segment."""
    out = segments if name is None else segments.filter(F.col("segment_name") == name)
    return out.select("user_id", *FEATURE_COLUMNS, "segment_name")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows for a log line; never the private showString."""
    return df.limit(n)
