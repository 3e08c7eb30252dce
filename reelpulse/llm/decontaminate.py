"""Benchmark decontamination.

The benchmark's windows (runs of ten words, or a shorter item as a whole) become
a set of hashes with their words.  Every document's token windows are hashed and
looked up in it; a hash hit is verified word by word, so the result is exact.
The set is broadcast only when the benchmark's text is below a stated size;
beyond it the same join is shuffled by hash, and a window's row then holds the
window's own words only.

Each row yields its windows and, beside the join, one marker row, so that
documents without hits stay in the result and nothing has to be joined back.
Rows are told apart by id and text, so nulls and equal ids are safe.

Defined results: null and empty texts have no words and no hits; repeated rows
each give their row; benchmark rows without words are ignored, those with a
null id can hit but are not named; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.llm.common import alnum_words, without

WINDOW = 10
#: Text bytes of the benchmark up to which its window set is broadcast (the set
#: is a small multiple of this).
BROADCAST_BYTES = 8 * 1024 * 1024


def benchmark_windows(bench: DataFrame, width: int = WINDOW, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """Distinct (item, w_len, w_hash, w_words) of all items."""
    items = bench.select(F.col(id_col).alias("item"), alnum_words(F.col(text_col)).alias("words")).filter(
        F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(width))
    return (
        items.withColumn("w_len", n)
        .select("item", "w_len", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("w_len") + 1)).alias("at"))
        .select("item", "w_len", F.slice("words", F.col("at"), F.col("w_len")).alias("w_words"))
        .distinct()
        .withColumn("w_hash", F.xxhash64("w_words"))
    )


def _broadcast_hits(rows: DataFrame, windows: DataFrame, grams: list) -> DataFrame:
    """(doc_id, text_key, at, len, n_words, item) of every hit, and a marker row
    with ``at`` -1 per row; documents stay where they are, in one scan."""
    known = windows.unionByName(rows.sparkSession.range(1).select(
        F.lit(None).cast(windows.schema["item"].dataType).alias("item"), F.lit(0).alias("w_len"),
        F.array().cast("array<string>").alias("w_words"), F.lit(0).cast("long").alias("w_hash")))
    marker = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("len"), F.lit(0).cast("long").alias("h")))
    exploded = rows.select("doc_id", "text_key", "words", F.inline(F.concat(marker, *grams)))
    return exploded.join(
        F.broadcast(known), (F.col("len") == F.col("w_len")) & (F.col("h") == F.col("w_hash"))
        & (F.slice("words", F.col("at") + 1 + F.when(F.col("at") < 0, 1).otherwise(0), F.col("len"))
           == F.col("w_words"))).withColumn("n_words", F.when(F.col("at") < 0, F.size("words")))


def _shuffled_hits(rows: DataFrame, windows: DataFrame, grams: list) -> DataFrame:
    """The same rows by a shuffled join.  A window's row carries only its own
    words, and the markers are added after the join, where no key is common to
    all documents."""
    markers = rows.select("doc_id", "text_key", F.lit(-1).alias("at"), F.lit(0).alias("len"),
                          F.size("words").alias("n_words"),
                          F.lit(None).cast(windows.schema["item"].dataType).alias("item"))
    if not grams:  # a benchmark without words
        return markers
    own = rows.select("doc_id", "text_key", "words", F.inline(F.concat(*grams))).select(
        "doc_id", "text_key", "at", "len", "h", F.slice("words", F.col("at") + 1, F.col("len")).alias("own_words"))
    hits = own.join(windows, (F.col("len") == F.col("w_len")) & (F.col("h") == F.col("w_hash"))
                    & (F.col("own_words") == F.col("w_words")))
    return markers.unionByName(hits.select("doc_id", "text_key", "at", "len", F.lit(None).cast("int").alias("n_words"),
                                           "item"))


def window_hits(docs: DataFrame, bench: DataFrame, width: int = WINDOW, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per distinct (doc_id, text) of ``docs``: doc_id, text_key, copies (equal
    rows), n_words, spans (sorted array of (at, len) of hit windows, words from
    0) and items (sorted array of hit item ids)."""
    windows = benchmark_windows(bench, width)
    # at most `width` different lengths
    lengths = sorted(r[0] for r in windows.select("w_len").distinct().collect())
    bench_bytes = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def grams(length):
        made = F.transform(F.sequence(F.lit(0), F.size("words") - length), lambda i: F.struct(
            i.cast("int").alias("at"), F.lit(length).alias("len"),
            F.xxhash64(F.slice("words", i + 1, F.lit(length))).alias("h")))
        return F.when(F.size("words") >= length, made).otherwise(F.array().cast("array<struct<at:int,len:int,h:bigint>>"))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.lit(1), F.col(text_col)).alias("text_key"),
                       alnum_words(F.col(text_col)).alias("words"))
    if bench_bytes <= BROADCAST_BYTES:
        hits = _broadcast_hits(rows, windows, [grams(n) for n in lengths])
    else:
        hits = _shuffled_hits(rows, windows, [grams(n) for n in lengths])
    return (
        hits.groupBy("doc_id", "text_key")
        .agg(F.count(F.when(F.col("at") < 0, 1)).alias("copies"),
             F.max("n_words").cast("long").alias("n_words"),
             F.collect_set(F.when(F.col("at") >= 0, F.struct("at", "len"))).alias("spans"),
             F.collect_set("item").alias("items"))
        .select("doc_id", "text_key", "copies", "n_words", F.array_sort("spans").alias("spans"),
                F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items"))
    )


def covered(spans) -> "F.Column":
    """Words covered by sorted (at, len) spans (long)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans, start,
        lambda acc, s: F.struct(
            (acc.n + F.greatest(s.at + s.len - F.greatest(acc.end, s.at), F.lit(0))).alias("n"),
            F.greatest(acc.end, s.at + s.len).alias("end")),
        lambda acc: acc.n)


def contamination(docs: DataFrame, bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, spans, items."""
    found = window_hits(docs, bench, width)
    return found.select(
        "doc_id", "text_key", "n_words", covered(F.col("spans")).alias("n_hit"), "spans", "items",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def dirty_keys(docs: DataFrame, bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct (doc_id, text_key, spans) of the rows with a hit."""
    return window_hits(docs, bench, width).filter(F.size("spans") > 0).select("doc_id", "text_key", "spans")


def clean_documents(docs: DataFrame, bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    dirty = dirty_keys(docs, bench, width).select("doc_id", "text_key")
    return without(docs, dirty, [F.col("doc_id"), F.xxhash64(F.lit(1), F.col("text"))])


def without_spans(docs: DataFrame, bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``.

    Clean rows keep their text as it is.  A row with hits keeps everything but
    the words of its hit windows: the text is taken apart into alternating gaps
    and words (so the k-th word has the place 2 k, or 2 k + 1 after a gap), the hit
    words become empty, and the rest is put together again.  The work grows with
    the text, not with its square.
    """
    dirty = dirty_keys(docs, bench, width).select(
        F.col("doc_id").alias("_dirty_id"), F.col("text_key").alias("_dirty_key"), F.col("spans").alias("_spans"))
    joined = docs.join(dirty, docs["doc_id"].eqNullSafe(F.col("_dirty_id"))
                       & (F.xxhash64(F.lit(1), docs["text"]) == F.col("_dirty_key")), "left")
    # word | gap pieces in order
    pieces = F.regexp_extract_all(F.col("text"), F.lit(r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), 1)
    # Each step is bound to a variable, so that no part of it is evaluated per word.
    hit_words = F.array_sort(F.array_distinct(F.flatten(F.transform("_spans", lambda s: F.sequence(s.at, s.at + s.len - 1)))))
    taken = F.array(F.struct(hit_words.alias("at"), pieces.alias("pieces")))
    flagged = F.transform(taken, lambda t: F.struct(  # one flag per word, up to the last hit word
        F.flatten(F.transform(t.at, lambda at, i: F.concat(
            F.array_repeat(F.lit(False), (at - F.coalesce(F.get(t.at, i - 1), F.lit(-1)) - 1).cast("int")),
            F.array(F.lit(True))))).alias("hit"),
        F.get(t.pieces, F.lit(0)).rlike(r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]").alias("word_first"),
        t.pieces.alias("pieces")))
    folded = F.get(F.transform(flagged, lambda f: F.array_join(F.transform(f.pieces, lambda p, i: F.when(
        ((i % 2 == 0) == f.word_first) & F.coalesce(F.get(f.hit, F.shiftright(i, 1)), F.lit(False)), F.lit("")
    ).otherwise(p)), "")), F.lit(0))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(folded)
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = contamination(docs, bench)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT item_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM bl)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT rid, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT rid, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT rid, count(DISTINCT p) AS n_hit
          FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN its USING (rid)
"""
