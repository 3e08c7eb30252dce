"""A lookup join whose hot keys do not meet in one task, without adaptive
execution (a micro-batch of a stream runs without it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more rows than a task's even share over this number; its rows
#: are dealt to that many parts a task.
PARTS_PER_TASK = 16


def hot_keys(df: DataFrame, key: str, parts_per_task: int = PARTS_PER_TASK) -> DataFrame:
    """(_hot, _parts) of the keys of ``df`` with more rows than 1/parts of all, where
    parts = tasks x ``parts_per_task``: at most ``parts`` rows, whatever the data.
    ``_hot`` is the key's hash: keys that share one are dealt alike, and Spark keeps a
    broadcast table of numbers in 1 MB, one of texts in pages of up to 64 MB."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * parts_per_task
    counts = df.groupBy(F.xxhash64(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    share = max(1.0, total / parts)
    return counts.filter(F.col("_n") > share).select("_hot", F.ceil(F.col("_n") / share).cast("int").alias("_parts"))


def spread_lookup(facts: DataFrame, dim: DataFrame, key: str, parts_per_task: int = PARTS_PER_TASK) -> DataFrame:
    """``facts`` left-joined to ``dim`` on ``key`` (unique in ``dim``).

    Rows with a null key have no match and go past the join.  Rows of a hot key are
    dealt to as many parts as it has shares of the batch, and its one dimension row
    is repeated for each part; the list of hot keys is bounded by the number of
    tasks (``hot_keys``), so it is broadcast.  Call it on a persisted frame: the
    keys are counted first.
    """
    known = facts.filter(F.col(key).isNotNull())
    hot = F.broadcast(hot_keys(known, key, parts_per_task))
    place = F.xxhash64(F.monotonically_increasing_id(), F.lit(7))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = (known.withColumn("_place", place).join(hot, F.xxhash64(key) == F.col("_hot"), "left")
            .withColumn("_part", F.pmod("_place", parts).cast("int")).drop("_place", "_hot", "_parts"))
    right = (dim.join(hot, F.xxhash64(key) == F.col("_hot"), "left")
             .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_hot", "_parts"))
    joined = left.join(right, [key, "_part"], "left").drop("_part")
    unmatched = facts.filter(F.col(key).isNull()).select(
        "*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields if f.name != key))
    return joined.unionByName(unmatched)
