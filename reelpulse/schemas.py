"""Explicit schemas for every logical input (see FIXTURES.md).

Inference is only an option in the readers: it makes column types depend on
the data (a telemetry file with no dirty dates infers a timestamp column).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, typ, True) for name, typ in fields])


# One JSON object per stream record; two event kinds share one flat schema.
CLICKSTREAM = _struct(
    ("event_type", S),
    ("current_timestamp", S),
    ("user_id", S),
    ("session_id", S),
    ("movie_id", S),
    ("device_type", S),
    ("watch_duration_minutes", D),
    ("progress_percentage", D),
    ("action", S),
    ("quality", S),
    ("user_rating", I),
    ("search_id", S),
    ("search_query", S),
    ("results_returned", I),
    ("clicked_result_position", I),
    ("search_duration_seconds", D),
    ("had_typo", S),
    ("location_country", S),
)

WATCH_FACT_COLUMNS = [
    "session_id", "user_id", "movie_id", "device_type",
    "watch_duration_minutes", "progress_percentage",
    "action", "quality", "user_rating", "location_country", "date_key",
]

SEARCH_FACT_COLUMNS = [
    "search_id", "user_id", "search_query", "results_returned",
    "clicked_result_position", "search_duration_seconds",
    "had_typo", "device_type", "location_country", "date_key",
]

# Facts landed by the stream ingest; date_key is declared as a string so
# partition discovery does not turn 2024011510 into an int (trap T1).
WATCH_FACT = _struct(
    ("session_id", S), ("user_id", S), ("movie_id", S), ("device_type", S),
    ("watch_duration_minutes", D), ("progress_percentage", D),
    ("action", S), ("quality", S), ("user_rating", I),
    ("location_country", S), ("date_key", S),
)

SEARCH_FACT = _struct(
    ("search_id", S), ("user_id", S), ("search_query", S),
    ("results_returned", I), ("clicked_result_position", I),
    ("search_duration_seconds", D), ("had_typo", S),
    ("device_type", S), ("location_country", S), ("date_key", S),
)

RAW_WATCH_COLUMNS = [
    "session_id", "user_id", "movie_id", "device_type",
    "watch_duration_minutes", "progress_percentage", "action", "quality",
    "user_rating", "location_country",
]
RAW_SEARCH_COLUMNS = [
    "search_id", "user_id", "search_query", "results_returned",
    "clicked_result_position", "search_duration_seconds", "had_typo",
    "device_type", "location_country",
]

USERS_RAW = _struct(
    ("user_id", S), ("age", D), ("gender", S), ("country", S),
    ("state_province", S), ("city", S), ("subscription_plan", S),
    ("is_active", B), ("monthly_spend", D), ("primary_device", S),
)

MOVIES_RAW = _struct(
    ("movie_id", S), ("title", S), ("content_type", S), ("genre_primary", S),
    ("genre_secondary", S), ("release_year", I), ("duration_minutes", D),
    ("imdb_rating", D), ("is_netflix_original", B),
)

DIM_USERS_COLUMNS = [
    "user_id", "age", "age_group", "gender", "country", "state_province",
    "city", "subscription_plan", "is_active", "monthly_spend", "primary_device",
]
DIM_MOVIES_COLUMNS = [
    "movie_id", "title", "content_type", "genre_primary", "genre_secondary",
    "release_year", "duration_minutes", "imdb_rating", "is_netflix_original",
]

TELEMETRY_RAW = _struct(
    ("timestamp", S), ("user_id", S), ("video_id", S), ("genre", S),
    ("video_title", S), ("watch_time_minutes", I), ("device_type", S),
)

SOCIAL_USERS_RAW = _struct(
    ("UserID", I), ("Name", S), ("Gender", S), ("DOB", S), ("City", S), ("Country", S),
)
SOCIAL_POSTS_RAW = _struct(
    ("post_id", S), ("timestamp", S), ("category", S), ("sentiment", S),
    ("language", S), ("likes", S), ("comments", S), ("shares", S), ("is_spam", S),
)

FEATURE_COLUMNS = [
    "total_views", "total_duration_minutes", "avg_progress_percentage", "night_view_ratio",
]

METRICS = _struct(
    ("query_id", S), ("query_name", S), ("batch_id", L), ("input_rows", L),
    ("input_rate", D), ("processed_rate", D), ("trigger_ms", L),
    ("records", L), ("malformed", L), ("null_user", L), ("mistyped", L),
)

# Views per movie of one micro-batch.
MOVIE_DELTA = _struct(("movie_id", S), ("count", L))

BATCH_STATS = _struct(("batch_id", L), ("event_type", S), ("count", L))
