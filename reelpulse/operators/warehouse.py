"""Star-schema dimensions: users, movies and a date dimension built from
the facts' hour keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpulse import schemas
from reelpulse.functions.columns import (
    HOUR_BUCKET_FORMAT,
    age_group,
    is_night_hour,
    is_weekend_day,
)


def dedupe_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key; the survivor is the smallest row in column order.

    ``min(struct(all columns))`` is an ordinary aggregate, so Spark
    combines map-side before the shuffle: a key holding a third of the
    table reaches the reducer as one row per map task instead of a huge
    window partition.  A null key is one group, as with dropDuplicates.
    """
    cols = df.columns
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*[F.col(c) for c in cols])).alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in cols])
    )


def dim_users(raw: DataFrame) -> DataFrame:
    with_group = raw.withColumn("age_group", age_group("age"))
    return dedupe_by_key(with_group, "user_id").select(*schemas.DIM_USERS_COLUMNS)


def dim_movies(raw: DataFrame) -> DataFrame:
    return dedupe_by_key(raw.select(*schemas.DIM_MOVIES_COLUMNS), "movie_id")


def dim_date(watch: DataFrame, search: DataFrame) -> DataFrame:
    """Distinct hour keys of both facts -> calendar attributes.

    Size bound: one row per distinct hour in the data's time span (8,760
    per year), whatever the fact volume.  A null key survives as one row
    and is reported by the null-key check (trap T18).
    """
    keys = watch.select("date_key").union(search.select("date_key")).distinct()
    ts = F.try_to_timestamp(F.col("date_key").cast("string"), F.lit(HOUR_BUCKET_FORMAT))
    return keys.select(F.col("date_key").cast("string").alias("date_key"), ts.alias("ts")).select(
        "date_key",
        F.col("ts").alias("full_timestamp"),
        F.hour("ts").alias("hour"),
        F.dayofmonth("ts").alias("day"),
        F.month("ts").alias("month"),
        F.year("ts").alias("year"),
        F.dayofweek("ts").alias("day_of_week"),
        F.date_format("ts", "E").alias("day_name"),
        is_weekend_day(F.dayofweek("ts")).alias("is_weekend"),
        is_night_hour(F.hour("ts")).alias("is_night"),
    )


def load_static_movies(spark: SparkSession, parquet_path: str, csv_path: str) -> DataFrame:
    """Movie lookup for the stream: the newest version of the dimension, or -
    only when that table does not exist - the raw CSV, cast and deduplicated (T9)."""
    from reelpulse.sources.io import load_table, table_exists

    if table_exists(spark, parquet_path):
        return load_table(spark, parquet_path).select("movie_id", "duration_minutes", "genre_primary")
    raw = spark.read.option("header", True).schema(schemas.MOVIES_RAW).csv(csv_path)
    return dedupe_by_key(
        raw.select("movie_id", F.col("duration_minutes").cast("double"), "genre_primary"), "movie_id"
    )


def register_views(spark: SparkSession, tables: dict) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_global_views(spark: SparkSession, tables: dict) -> None:
    """Views readable from any session of this application as
    ``global_temp.<name>``; they die with the application."""
    for name, df in tables.items():
        df.createOrReplaceGlobalTempView(name)
