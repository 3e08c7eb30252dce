"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpulse.session import scratch_dir
from reelpulse.sources import fs

# The two word definitions of the corpus operators.  A "plain"
# word is a run of non-blank characters; an "alnum" word is a run of ASCII
# digits, ASCII lower-case letters and non-ASCII characters.
BLANKS = r"[\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of an Arrow batch of whole texts.
TEXTS_AT_ONCE = 500
#: Bits a key of the bitmaps of ``without``, and the powers of two that bound a
#: bitmap (8 MB, sent to every task); a piece of it is one row.
KEY_BITS, LEAST_KEY_BITS, MOST_KEY_BITS = 32, 15, 26
PIECE = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (any store that Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage with a table that outlives a lost executor, gives the
    planner real file sizes, and lets later stages read it more than once.  The
    shuffle files of the writing go with its end: nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, 'llm', name, unique=True)}/table"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = TEXTS_AT_ONCE):
    """Arrow batches of at most ``rows`` rows for the actions inside: a batch of whole
    texts is held by Spark and by the Python worker at once."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the actions inside (on data frames made inside) are removed
    when the action ends, not when the driver's garbage is collected."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def drop_stored(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in tables:
        files = df.inputFiles()
        if files:
            fs.remove(df.sparkSession, files[0].rsplit("/", 1)[0])


def _bit_place(columns: list[Column], bits: int, seed: int) -> tuple[Column, Column]:
    """Piece of a bitmap and bit in it."""
    place = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << bits).cast("long"))
    return F.floor(place / PIECE).alias("_piece"), (place % PIECE).alias("_bit")


def _with_hit(rows: DataFrame, columns: list[Column], keys: DataFrame, seed: int) -> DataFrame:
    """``rows`` and ``_hit``: whether the bit of a row's ``columns`` is set in the
    bitmap of ``keys``.  Rows stay where they are."""
    bits = min(max((KEY_BITS * keys.count()).bit_length(), LEAST_KEY_BITS), MOST_KEY_BITS)
    places = keys.select(*_bit_place([F.col(c) for c in keys.columns], bits, seed))
    # keys move, not every task's bitmap
    pieces = places.repartition("_piece").groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    piece, bit = _bit_place(columns, bits, seed)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.floor(byte / F.pow(F.lit(2), F.col("_bit") % 8)) % 2 == 1
    return (rows.select("*", piece, bit).join(F.broadcast(pieces), "_piece", "left")  # at most 8 MB
            .select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("_hit")))


def among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` whose ``column`` is in the one column of the stored ``keys``: a bitmap
    of the keys' hashes first, so that few other rows are shuffled."""
    found = _with_hit(rows, [F.col(column)], keys, 1).filter("_hit").drop("_hit")
    return found.join(keys.toDF("_key"), F.col(column) == F.col("_key"), "left_semi")


def without(rows: DataFrame, keys: DataFrame, columns: list[Column]) -> DataFrame:
    """``rows`` whose ``columns`` are no row of ``keys`` (nulls are equal), with
    hardly a row of ``rows`` shuffled.

    A bitmap of the keys' hashes tells rows that are surely not among them.  The
    keys of rows that it takes for one by chance make a second bitmap: what the
    first has and the second has not is surely among the keys.  The rest, a few
    hundredths, is joined by the keys.  Beyond two million keys the bitmaps grow
    no more and the rest gets larger.
    """
    names = [f"_key{i}" for i in range(len(columns))]
    keys = stored(keys.toDF(*names).distinct(), "keys")

    def anti(left, right):
        right = right.toDF(*["_of" + c for c in names])
        return left.join(right, [F.col(c).eqNullSafe(F.col("_of" + c)) for c in names], "left_anti")

    keyed = rows.select("*", *[c.alias(n) for n, c in zip(names, columns, strict=True)])
    first = _with_hit(keyed, [F.col(c) for c in names], keys, 1)
    chance = stored(anti(first.filter("_hit").select(*names).distinct(), keys), "chance_keys")
    second = _with_hit(first.filter("_hit").drop("_hit"), [F.col(c) for c in names], chance, 2)
    return (first.filter("not _hit").select(*rows.columns)
            .unionByName(anti(second.filter("_hit"), keys).select(*rows.columns)))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(text, UPPER, UPPER.lower())


def alnum_words(text: Column) -> Column:
    """Array of alnum words of a lower-cased text; null text gives no words."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), ALNUM_GAP), "")


def plain_word_count(text: Column) -> Column:
    """Number of plain words (long); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("long")


def hash32(value: Column) -> Column:
    """First 32 bits of the MD5 of a string as a long: a hash that any SQL
    engine with ``md5`` computes alike."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")
