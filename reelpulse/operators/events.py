"""Clickstream events: encode, parse, normalise, route and enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelpulse import schemas
from reelpulse.functions.columns import (
    EVENT_TIME_FORMAT,
    blank_to_null,
    capped_progress,
    digits_int,
    hour_bucket,
    is_blank,
    number_or_default,
    parse_time,
)
from reelpulse.operators.joins import spread_lookup


def to_json_value(df: DataFrame, keep=()) -> DataFrame:
    """One JSON text per row (the producer's encoding) in ``value``, next
    to any ``keep`` columns.  Timestamps are formatted first: ``to_json``
    would write ISO text with a ``T``."""
    body = [
        F.date_format(c, EVENT_TIME_FORMAT).alias(c) if t.startswith("timestamp") else F.col(c)
        for c, t in df.dtypes if c not in keep
    ]
    return df.select(*keep, F.to_json(F.struct(*body)).alias("value"))


_CORRUPT = "_corrupt_record"
#: Name of the reject counts in a query's progress.
REJECTS = "rejects"


def reject_counts(schema=schemas.CLICKSTREAM) -> list:
    """Aggregates over parsed rows (see ``parse_events``): ``records`` in all, of
    these ``malformed`` ones (not a JSON object), ``null_user`` ones (an object without
    a user), and ``mistyped`` fields (a value that its type cannot take; the
    row stays, the field is null).  Only rows that the parser marked are looked at
    twice."""
    fields = F.from_json(F.col(_CORRUPT), "map<string,string>")
    malformed = F.col(_CORRUPT).isNotNull() & fields.isNull() | F.col("_missing")
    wrong = F.lit(0)
    for f in schema.fields:
        if f.dataType.typeName() != "string":
            wrong = wrong + F.coalesce(fields[f.name].isNotNull() & F.col(f.name).isNull(), F.lit(False)).cast("int")

    def total(what):
        return F.coalesce(F.sum(what), F.lit(0)).cast("long")

    return [F.count(F.lit(1)).alias("records"), total(malformed.cast("int")).alias("malformed"),
            total((~malformed & F.col("user_id").isNull()).cast("int")).alias("null_user"),
            total(F.when(F.col(_CORRUPT).isNotNull(), wrong).otherwise(0)).alias("mistyped")]


def parse_events(values: DataFrame, schema=schemas.CLICKSTREAM, observe: str | None = None) -> DataFrame:
    """JSON text -> flat event columns + ``ts`` + hour ``date_key``.

    Malformed JSON parses to an all-null struct and is removed by the
    null-user filter; a badly typed field only nulls itself (trap T3).  With
    ``observe`` the reject counts of each run (of a stream: each micro-batch) are
    reported as observed metrics under that name.
    """
    value = F.col("value").cast("string")
    if observe is None:
        parsed = values.select(F.from_json(value, schema).alias("data")).select("data.*")
    else:
        marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
        parsed = values.select(F.from_json(value, marked, {"columnNameOfCorruptRecord": _CORRUPT}).alias("data"),
                               (value.isNull() | (F.trim(value) == "")).alias("_missing")).select("data.*", "_missing")
        parsed = parsed.observe(observe, *reject_counts(schema)).drop(_CORRUPT, "_missing")
    return (
        parsed.filter(F.col("user_id").isNotNull())
        .withColumn("ts", parse_time("current_timestamp"))
        .withColumn("date_key", hour_bucket("ts"))
    )


def route(events: DataFrame, kind: str) -> DataFrame:
    """Keep one event kind; unknown kinds are dropped silently."""
    return events.filter(F.col("event_type") == kind)


EVENT_KINDS = ("watch", "search")


def kind_counts(events: DataFrame) -> DataFrame:
    """Events of every event_type, null included.  The kind is free text from
    outside, so the rows are not bounded; write them, do not collect them."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


def event_stats(events: DataFrame) -> DataFrame:
    """A summary of at most three rows: the known kinds, and all others as
    ``other``.  ``kind_counts`` has every kind."""
    kind = F.when(F.col("event_type").isin(*EVENT_KINDS), F.col("event_type")).otherwise(F.lit("other"))
    return events.groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("count"))


def watch_facts(watch: DataFrame, movies: DataFrame, spread: bool = False) -> DataFrame:
    """Watch events left-joined to the movie dimension with the capped
    progress percentage; unknown movies keep their rows (progress 0.0).

    ``movies`` is a dimension keyed by movie_id; only its two needed
    columns take part in the join, and Spark picks broadcast vs. shuffle
    from its size (AQE re-checks at run time, and splits a hot movie).
    ``spread`` is for a micro-batch, which runs without AQE: null keys go past
    the join and hot movies are dealt to several tasks.
    """
    key_type = watch.schema["movie_id"].dataType
    dim = movies.select(F.col("movie_id").cast(key_type).alias("movie_id"), F.col("duration_minutes").alias("_length"))
    joined = spread_lookup(watch, dim, "movie_id") if spread else watch.join(dim, "movie_id", "left")
    return joined.withColumn(
        "progress_percentage", capped_progress("watch_duration_minutes", "_length")
    ).select(*schemas.WATCH_FACT_COLUMNS)


def search_facts(search: DataFrame) -> DataFrame:
    return search.select(*schemas.SEARCH_FACT_COLUMNS)


def normalize_watch(raw: DataFrame) -> DataFrame:
    """Raw watch CSV rows (all text) -> typed watch event.

    Empty user -> null; empty duration -> 0.0; progress is reset to 0.0;
    rating only when all digits; country defaults only when the column
    is missing, an empty value stays empty (trap T13).
    """
    cols = set(raw.columns)
    country = F.col("location_country") if "location_country" in cols else F.lit("Unknown")
    return raw.select(
        F.col("session_id"),
        blank_to_null("user_id").alias("user_id"),
        F.col("movie_id"),
        F.col("device_type"),
        number_or_default("watch_duration_minutes", 0.0).alias("watch_duration_minutes"),
        F.lit(0.0).alias("progress_percentage"),
        F.col("action"),
        F.col("quality"),
        digits_int("user_rating").alias("user_rating"),
        country.alias("location_country"),
        F.lit("watch").alias("event_type"),
    )


def normalize_search(raw: DataFrame) -> DataFrame:
    """Raw search CSV rows -> typed search event (defaults as above)."""
    cols = set(raw.columns)
    country = F.col("location_country") if "location_country" in cols else F.lit("Unknown")
    typo = F.col("had_typo") if "had_typo" in cols else F.lit("False")
    click = F.col("clicked_result_position")
    return raw.select(
        F.col("search_id"),
        blank_to_null("user_id").alias("user_id"),
        F.col("search_query"),
        number_or_default("results_returned", 0, "int").alias("results_returned"),
        F.when(is_blank(click), F.lit(None).cast("int")).otherwise(click.try_cast("int")).alias("clicked_result_position"),
        number_or_default("search_duration_seconds", 0.0).alias("search_duration_seconds"),
        typo.alias("had_typo"),
        F.col("device_type"),
        country.alias("location_country"),
        F.lit("search").alias("event_type"),
    )
