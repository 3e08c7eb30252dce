"""Row numbers over a whole table, or over groups that may be huge, without a
one-task window.

A range sort deals the rows to partitions in order; each partition numbers its
own rows, a small table of per-partition counts is turned into prefix offsets,
and every row adds its partition's offset.  No task holds more than one range
of the sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpulse.session import scratch_dir

_AT, _PART, _FIRST, _BEFORE = "_rank_at", "_rank_part", "_rank_first", "_rank_before"
# monotonically_increasing_id keeps the row's place in the low 33 bits.
_ROW_BITS = 33


def _kept(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{scratch_dir(spark, 'ranking', name, unique=True)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), rank_col: str = "rank",
           size_col: str | None = None) -> DataFrame:
    """``df`` with ``rank_col``: 0, 1, 2, ... in the given order inside each value
    of the ``by`` columns (null is a value), and with ``size_col``, if named, the
    number of rows of that value.

    The sorted rows are written once below the shared scratch folder, so the
    numbers and the counts they rest on come from the same pass, and a lost
    executor does not renumber anything.  Rows that tie in the order get
    different numbers, in no stated order.  An empty table stays empty.  The
    added columns must not be in ``df`` already.
    """
    by = list(by)
    # Tied rows spread over the ranges by their place in the input.
    keys = [*(F.col(c).asc_nulls_first() for c in by), *order]
    placed = df.withColumn(_AT, F.monotonically_increasing_id())
    ordered = (placed.repartitionByRange(*keys, F.col(_AT)).sortWithinPartitions(*keys, _AT)
               .withColumn(_AT, F.monotonically_increasing_id()))
    rows = _kept(ordered, "rows").withColumn(_PART, F.shiftright(_AT, _ROW_BITS))
    counts = rows.groupBy(*by, _PART).agg(F.count(F.lit(1)).alias("_n"), F.min(_AT).alias(_FIRST))
    before = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(_BEFORE, F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if size_col:
        offsets = offsets.withColumn(size_col, F.sum("_n").over(Window.partitionBy(*by)))
    # One row per partition and value: stored, so the planner broadcasts it by its
    # size or, for many values, joins it shuffled.
    offsets = _kept(offsets.drop("_n"), "offsets")
    o, r = offsets.alias("o"), rows.alias("r")
    same = F.col(f"r.{_PART}") == F.col(f"o.{_PART}")
    for c in by:
        same = same & F.col(f"r.`{c}`").eqNullSafe(F.col(f"o.`{c}`"))
    extra = [F.col(f"o.`{size_col}`")] if size_col else []
    rank = F.col(f"r.{_AT}") - F.col(f"o.{_FIRST}") + F.col(f"o.{_BEFORE}")
    return r.join(o, same).select(*(F.col(f"r.`{c}`") for c in df.columns), rank.alias(rank_col), *extra)
