"""Social-media documents: load users/posts/feeds and the document-style
rollups (group / sort / limit / lookup / unwind / project) as DataFrame
operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.functions.columns import years_since


def load_social_users(raw: DataFrame, as_of) -> DataFrame:
    """Users CSV -> documents: renamed fields, integer id, age as the
    difference of calendar years to ``as_of``; a bad birth date -> null."""
    return raw.select(
        F.col("UserID").cast("int").alias("user_id"),
        F.col("Name").alias("name"),
        F.col("Gender").alias("gender"),
        years_since("DOB", as_of).alias("age"),
        F.col("City").alias("city"),
        F.col("Country").alias("country"),
    )


def load_social_posts(raw: DataFrame) -> DataFrame:
    """Posts CSV -> documents with integer counters (a bad integer fails
    the job, as a strict loader should)."""
    ints = ("post_id", "likes", "comments", "shares", "is_spam")
    return raw.select(
        F.col("post_id").cast("int").alias("post_id"),
        "timestamp", "category", "sentiment", "language",
        *[F.col(c).cast("int").alias(c) for c in ints[1:]],
    )


def action_distribution(feeds: DataFrame) -> DataFrame:
    return feeds.groupBy("action").agg(F.count(F.lit(1)).alias("count"))


def top_categories(posts: DataFrame, n: int = 5) -> DataFrame:
    return (
        posts.groupBy("category")
        .agg(F.count(F.lit(1)).alias("posts"))
        .orderBy(F.desc("posts"), F.asc("category"))
        .limit(n)
    )


def top_active_users(feeds: DataFrame, n: int = 5) -> DataFrame:
    return (
        feeds.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("total_actions"))
        .orderBy(F.desc("total_actions"), F.asc("user_id"))
        .limit(n)
    )


def top_active_users_detail(feeds: DataFrame, users: DataFrame, n: int = 5) -> DataFrame:
    """Top-n users by actions, *then* their details: a lookup + unwind is an
    inner join (a user missing from ``users`` drops out, so fewer than n
    rows is legal; a duplicated user yields one row per match).  The
    lookup matches null to null, hence the null-safe equality (trap T7)."""
    top = top_active_users(feeds, n)
    u = users.select(F.col("user_id").alias("_uid"), "name", "country")
    return top.join(u, top["user_id"].eqNullSafe(u["_uid"]), "inner").select(
        "user_id", "name", "country", "total_actions"
    )
