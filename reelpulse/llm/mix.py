"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words.  Each of its documents is expected
``target / source_size`` times; the expectations are prefix-summed over the
source, one offset in [0, 1) is added, and a document is emitted once for every
integer boundary its interval crosses.

The prefix sum needs no task that holds a whole source.  Documents are ordered
within a source by (size class, hash slice, size, hash); because all documents
of a source have the same expectation, the prefix sum is ``rank * expectation``,
and the rank is the offset of the (size class, hash slice) cell, taken from a
small table of cell counts, plus the rank inside the cell.  Ordering by size
class stratifies the sample by length, so the taken words stay near the target.
Whole documents can miss it by up to the longest one, so a fixed number of random
offsets is drawn per source and the one that comes nearest is used.

Defined results: null text and blank text have size 0; a null source is a source
of its own, ordered last; every input row gets one output row (repeated rows are
sampled one by one); an empty table gives an empty result.  Input columns other
than the named ones never clash with the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpulse.llm.common import hash32, plain_word_count, stored

MAX_REPEATS = 3
WEIGHT_CYCLE = 3
HASH_SLICES = 64
#: Random offsets tried per source.
OFFSETS = 16


def size_class(size: Column) -> Column:
    """Four classes per doubling of the size, in exact arithmetic."""
    octave = F.length(F.bin(size))
    return (octave * 8 + F.floor(size * 8 / F.pow(F.lit(2.0), octave))).cast("int")


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS,
                   cycle: int = WEIGHT_CYCLE) -> DataFrame:
    """Targets of (skey, source_size) rows, one row per source.

    Sources by code point, null last, weigh 1..``cycle``, repeating, and share
    all words.  A target stops at ``max_repeats`` times its source's size and
    the excess goes to the others by weight.  The level to which the uncapped
    sources rise is found with running sums over the sources sorted by
    cap / weight: the first one whose cap lies above the level that is left
    settles it.  One row per source, so the unpartitioned windows stay small.
    """
    by_name = Window.orderBy((F.col("skey") == "n"), "skey")
    by_ratio = F.struct("ratio", "skey")
    before = Window.orderBy("ratio", "skey").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (
        sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("long"))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("level", level)
        .withColumn("free_level", F.min_by(
            "level", F.when(F.col("level") <= F.col("ratio"), by_ratio)).over(everything))
        .withColumn("target", F.least(
            F.col("cap").cast("double"),
            F.coalesce(F.col("free_level") * F.col("weight"), F.col("cap").cast("double"))))
        .select("skey", "source_size", "target")
    )


def random_offset(seed: str, k: int) -> Column:
    """The k-th random offset of a source, in [0, 1)."""
    return hash32(F.concat(F.lit(f"{seed}|offset {k}|"), F.col("skey"))) / F.lit(4294967296.0)


def copies(offset: Column) -> Column:
    """Integer boundaries between a document's prefix sums."""
    return (F.floor((F.col("rank") + 1) * F.col("each") + offset)
            - F.floor(F.col("rank") * F.col("each") + offset)).cast("int")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             size: Column | None = None, text_col: str = "text", seed: str = "mix",
             keep_row: bool = False, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """How often each row of ``docs`` is taken.

    Returns doc_id, size, source_size, target, copies (and ``row``, a struct of
    all input columns, with ``keep_row``); ``size`` overrides the plain word
    count of ``text_col``.
    """
    size = plain_word_count(F.col(text_col)) if size is None else size
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    base = docs.select(
        F.col(id_col).alias("doc_id"), size.alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")).alias("skey"),
        hash32(F.concat(F.lit(f"{seed}|"), key)).alias("spread"),
        *([F.struct(*docs.columns).alias("row")] if keep_row else []),
    ).withColumn("cls", size_class(F.col("size"))).withColumn(
        "part", (F.col("spread") % HASH_SLICES).cast("int"))
    # at most HASH_SLICES x a few dozen size classes per source, whatever the input
    cells = stored(base.groupBy("skey", "cls", "part").agg(
        F.count("*").alias("n"), F.sum("size").alias("words")), "mix_cells")
    targets = source_targets(cells.groupBy("skey").agg(F.sum("words").alias("source_size")), max_repeats)
    cell_order = Window.partitionBy("skey").orderBy("cls", "part")
    starts = stored(
        cells.withColumn("start", F.sum("n").over(cell_order) - F.col("n"))
        .join(targets, "skey")
        .select("skey", "cls", "part", "start", "source_size", "target",
                F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                .otherwise(F.lit(0.0)).alias("each")),
        "mix_starts")
    in_cell = Window.partitionBy("skey", "cls", "part").orderBy("size", "spread", "doc_id")

    def ranked(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("i", F.row_number().over(in_cell) - 1).join(starts, ["skey", "cls", "part"])
                .withColumn("rank", F.col("start") + F.col("i")))

    # words that each random offset would take, per source; the nearest offset is used
    tried = ranked(base.drop("row")).groupBy("skey", "target").agg(
        *[F.sum(F.col("size") * copies(random_offset(seed, k))).alias(f"w{k}") for k in range(OFFSETS)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"w{k}") - F.col("target")).alias("miss"),
                                          F.lit(k).alias("k"), random_offset(seed, k).alias("offset"))
                                 for k in range(OFFSETS)]))
    chosen = stored(tried.select("skey", best["offset"].alias("offset")), "mix_offsets")
    return ranked(base).join(chosen, "skey").select(
        "doc_id", "size", "source_size", "target", copies(F.col("offset")).alias("copies"),
        *(["row"] if keep_row else []))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, with
    its own columns."""
    plan = mix_plan(docs, keep_row=True, **options)
    return plan.filter("copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def op10_systematic_mix(spark, sf_dir: str) -> DataFrame:
    """Mix of all documents: the words that each document contributes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = stored(docs.select("doc_id", "source", plain_word_count(F.col("text")).alias("size")), "mix_sizes")
    plan = mix_plan(sizes, size=F.col("size"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_OP10 = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce('s' || source, 'n') AS skey,
         ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '-')), 1, 8))::BIGINT AS spread
  FROM documents),
src AS (
  SELECT skey, sum(size)::DOUBLE AS source_size,
         (row_number() OVER (ORDER BY skey = 'n', skey) - 1) % 3 + 1 AS weight
  FROM base GROUP BY skey),
-- the rule as stated: share by weight, stop at three times the size, share the excess again
fill AS (
  SELECT 0 AS step, skey, source_size, weight, 0.0::DOUBLE AS target, false AS capped FROM src
  UNION ALL
  SELECT step + 1, skey, source_size, weight,
         CASE WHEN capped THEN target ELSE least(3 * source_size, share) END,
         capped OR share > 3 * source_size
  FROM (SELECT *, weight * (sum(source_size) OVER () - sum(CASE WHEN capped THEN target ELSE 0 END) OVER ())
                  / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0) AS share,
               sum(CASE WHEN capped THEN 0 ELSE 1 END) OVER () AS open_sources
        FROM fill WHERE step < (SELECT count(*) + 1 FROM src))),
targets AS (SELECT skey, source_size, target FROM fill WHERE step = (SELECT count(*) + 1 FROM src)),
ranked AS (
  SELECT b.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
         row_number() OVER (PARTITION BY b.skey ORDER BY
           length(bin(size)) * 8 + floor(size * 8 / pow(2.0, length(bin(size)))),
           spread % 64, size, spread, doc_id) AS r
  FROM base b JOIN targets t USING (skey)),
offsets AS (
  SELECT skey, k, ('0x' || substr(md5('mix|offset ' || k || '|' || skey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS off
  FROM src, range(16) AS g(k)),
tried AS (
  SELECT skey, k, off, abs(sum((size * (floor(r * each + off) - floor((r - 1) * each + off)))::BIGINT)
                           - any_value(target)) AS miss
  FROM ranked JOIN offsets USING (skey) GROUP BY skey, k, off),
chosen AS (SELECT skey, off FROM tried QUALIFY row_number() OVER (PARTITION BY skey ORDER BY miss, k) = 1)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (floor(r * each + off) - floor((r - 1) * each + off)))::BIGINT AS taken
FROM ranked JOIN chosen USING (skey)
"""
