"""Stupid-backoff language-model scores, computed relationally.

The model's n-gram counts cover all documents.  Everything is a join on n-grams:

1. Documents are dealt into blocks by id.  Each block is exploded into its
   distinct n-grams of orders 1 to ``order`` with their counts in the block,
   dealt into hash buckets (one row per block and bucket, hashes packed).
2. Per bucket, the rows of all blocks are summed: the bucket's part of the
   n-gram count table, joined right there to the rows that asked for it.  A
   frequent n-gram is one entry per block, so no bucket is hot.
3. The counts go back to their block, are matched with the n-grams of every
   word, and the word scores are summed per document.

A word w after u v scores count(u v w) / count(u v) if count(u v w) reaches
``min_count``, else ``alpha`` times its score after v, down to
count(w) / all words.  N-grams are told apart by 56-bit hashes.

Defined results: null and blank texts have 0 words and score 0; each input row
gets one row, and repeated rows count like other documents; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.llm.ngrams import ngram_hashes, plain_words, word_hashes

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 2
BLOCK_ROWS = 2048
#: Text bytes whose n-grams fall on one bucket, as expected.
BUCKET_BYTES = 8 * 1024 * 1024
#: Bits of an n-gram's hash.
HASH_BITS = 56
#: Key under which the number of all words is counted.
ALL_WORDS = np.uint64(0)


def bucket_count(text_bytes: int, partitions: int) -> int:
    """Hash buckets: two per shuffle partition at least, and as many more as the
    text needs, so that a bucket's n-grams do not grow with the input."""
    return max(2 * partitions, math.ceil(text_bytes / BUCKET_BYTES))


def packed(keys: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """Sorted distinct hashes as (first, width, low, top): their differences, of
    ``width`` bytes each.  Neighbours among many hashes are close, so this is
    lossless and short; only the top bytes are not random, so only they are
    compressed."""
    gaps = np.diff(keys)
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    columns = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return (int(keys[:1].view(np.int64)[0]), width, columns[:, :-1].tobytes(),
            zlib.compress(columns[:, -1].tobytes(), 1))


def unpacked(first: int, width: int, low: bytes, top: bytes) -> np.ndarray:
    last = np.frombuffer(zlib.decompress(top), np.uint8)
    wide = np.zeros((len(last) + 1, 8), np.uint8)
    wide[1:, :width - 1] = np.frombuffer(low, np.uint8).reshape(len(last), width - 1)
    wide[1:, width - 1] = last
    keys = wide.view("<u8").reshape(-1)
    keys[0] = np.array([first], np.int64).view(np.uint64)[0]
    return np.cumsum(keys, dtype=np.uint64)


def short_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as one byte each, compressed; 255 stands for the next of the large
    ones."""
    return zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), 1), counts[counts >= 255].astype("<u8").tobytes()


def full_counts(small: bytes, large: bytes) -> np.ndarray:
    counts = np.frombuffer(zlib.decompress(small), np.uint8).astype(np.uint64)
    counts[counts == 255] = np.frombuffer(large, "<u8")
    return counts


class Block:
    """The n-grams of a block of documents."""

    def __init__(self, texts: list, order: int):
        split = [plain_words(t) for t in texts]
        self.sizes = np.fromiter(map(len, split), np.int64, len(split))
        flat = word_hashes([w for words in split for w in words])
        ends = np.cumsum(self.sizes)
        self.doc = np.repeat(np.arange(len(split)), self.sizes)
        # words before this one in its document
        self.place = np.arange(len(flat)) - np.repeat(ends - self.sizes, self.sizes)
        self.grams = []  # per order: (positions of last words, hashes)
        for n in range(1, order + 1):
            hashes = ngram_hashes(flat, n)
            inside = self.place[n - 1:] >= n - 1 if len(hashes) else np.zeros(0, bool)
            self.grams.append((np.flatnonzero(inside) + n - 1, hashes[inside]))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct n-gram hashes of all orders (and ALL_WORDS, first),
        their counts, and the place of every n-gram among them."""
        every = np.concatenate([h for _, h in self.grams]) >> np.uint64(64 - HASH_BITS)
        keys, where, counts = np.unique(every, return_inverse=True, return_counts=True)
        keys = np.concatenate([[ALL_WORDS], keys])
        return keys, np.concatenate([[len(self.place)], counts]), where + 1

    def scores(self, totals: np.ndarray, where: np.ndarray, alpha: float, min_count: int):
        """Log score and number of backed-off words per document."""
        n_words, all_words = len(self.place), float(totals[0])
        counts, at = [], 0
        for positions, hashes in self.grams:
            full = np.zeros(n_words, np.float64)  # count of the n-gram that ends at each word
            full[positions] = totals[where[at:at + len(hashes)]]
            counts.append(full)
            at += len(hashes)
        score = np.log(np.maximum(counts[0], 1.0)) - math.log(max(all_words, 1.0))
        steps = np.minimum(self.place, len(counts) - 1)  # backed-off steps so far
        for n in range(2, len(counts) + 1):
            hit = (self.place >= n - 1) & (counts[n - 1] >= min_count)
            context = np.concatenate([[1.0], counts[n - 2][:-1]]) if n_words else counts[n - 2]
            score[hit] = np.log(counts[n - 1][hit]) - np.log(context[hit])
            steps[hit] = np.minimum(self.place[hit], len(counts) - 1) - (n - 1)
        score += steps * math.log(alpha)
        docs = len(self.sizes)
        return (np.bincount(self.doc, score, docs).astype(np.float64),
                np.bincount(self.doc, steps > 0, docs).astype(np.int64))


def lm_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, min_count: int = MIN_COUNT,
              block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, log_score (sum of natural
    logs), n_backoff (words scored below the highest order they could have)."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    n_rows, text_bytes = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, math.ceil(n_rows / block_rows))
    buckets = bucket_count(text_bytes or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    id_type = docs.schema[id_col].dataType.simpleString()
    key = F.coalesce(F.xxhash64(F.col("doc_id").cast("string")), F.lit(0)) if blocks > 1 else F.lit(0)
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(key)
    rows = rows.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int"))

    def bucket_edges(keys):
        starts = np.arange(1, buckets, dtype=np.float64) * (2.0 ** HASH_BITS / buckets)
        return [0, *np.searchsorted(keys, starts.astype(np.uint64)).tolist(), len(keys)]

    def explode(table: pa.Table) -> pa.Table:
        keys, counts, _ = Block(table.column("text").to_pylist(), order).distinct()
        edges = bucket_edges(keys)
        parts = [(b, slice(i, j)) for b, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if j > i]
        short = [packed(keys[s]) for _, s in parts]
        counted = [short_counts(counts[s]) for _, s in parts]
        return pa.table({
            "block": pa.array([table.column("block")[0].as_py()] * len(parts), pa.int32()),
            "bucket": pa.array([b for b, _ in parts], pa.int32()),
            "first": pa.array([p[0] for p in short], pa.int64()),
            "width": pa.array([p[1] for p in short], pa.int32()),
            "low": pa.array([p[2] for p in short], pa.binary()),
            "top": pa.array([p[3] for p in short], pa.binary()),
            "counts": pa.array([c[0] for c in counted], pa.binary()),
            "large": pa.array([c[1] for c in counted], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        hashes = [unpacked(*x) for x in zip(*(table.column(c).to_pylist() for c in ("first", "width", "low", "top")),
                                            strict=True)]
        counts = np.concatenate([full_counts(*x) for x in zip(
            *(table.column(c).to_pylist() for c in ("counts", "large")), strict=True)])
        keys, where = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(where, counts, len(keys)).astype(np.uint64)[where]
        edges = np.cumsum([0, *map(len, hashes)])
        summed = [short_counts(sums[i:j]) for i, j in zip(edges, edges[1:], strict=False)]
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"),
            "totals": pa.array([c[0] for c in summed], pa.binary()),
            "large": pa.array([c[1] for c in summed], pa.binary())})

    def score(texts: pa.Table, counted: pa.Table) -> pa.Table:
        block = Block(texts.column("text").to_pylist(), order)
        _, _, where = block.distinct()
        parts = sorted(zip(*(counted.column(c).to_pylist() for c in ("bucket", "totals", "large")), strict=True))
        totals = np.concatenate([full_counts(*x) for _, *x in parts])
        log_score, n_backoff = block.scores(totals, where, alpha, min_count)
        return pa.table({"doc_id": texts.column("doc_id"), "n_words": pa.array(block.sizes),
                         "log_score": pa.array(log_score), "n_backoff": pa.array(n_backoff)})

    asked = rows.groupBy("block").applyInArrow(explode, "block int, bucket int, first long, width int, low binary, top binary, counts binary, large binary")
    counted = asked.groupBy("bucket").applyInArrow(total, "block int, bucket int, totals binary, large binary")
    return rows.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        score, f"doc_id {id_type}, n_words long, log_score double, n_backoff long")


def op2_stupid_backoff(spark, sf_dir: str) -> DataFrame:
    """Trigram stupid-backoff scores of every document, counts over all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return lm_scores(docs).select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), "n_backoff")


ORACLE_OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
x AS (SELECT rid, unnest(w) AS c, unnest(generate_series(1, len(w))) AS i FROM d),
t AS (SELECT rid, i, c, lag(c) OVER p AS b, lag(c, 2) OVER p AS a FROM x WINDOW p AS (PARTITION BY rid ORDER BY i)),
n1 AS (SELECT c, count(*) AS k FROM t GROUP BY c),
n2 AS (SELECT b, c, count(*) AS k FROM t WHERE i >= 2 GROUP BY b, c),
n3 AS (SELECT a, b, c, count(*) AS k FROM t WHERE i >= 3 GROUP BY a, b, c),
every AS (SELECT count(*) AS k FROM t),
s AS (
  SELECT t.rid, i,
         CASE WHEN i >= 3 AND n3.k >= 2 THEN ln(n3.k) - ln(ab.k)
              WHEN i >= 2 AND n2.k >= 2 THEN ln(n2.k) - ln(u.k) + (CASE WHEN i >= 3 THEN 1 ELSE 0 END) * ln(0.4)
              ELSE ln(n1.k) - ln(every.k) + least(i - 1, 2) * ln(0.4) END AS score,
         CASE WHEN i = 1 OR (i = 2 AND n2.k >= 2) OR (i >= 3 AND n3.k >= 2) THEN 0 ELSE 1 END AS backed
  FROM t JOIN n1 ON t.c = n1.c CROSS JOIN every
  LEFT JOIN n2 ON t.i >= 2 AND t.b = n2.b AND t.c = n2.c
  LEFT JOIN n1 u ON t.b = u.c
  LEFT JOIN n3 ON t.i >= 3 AND t.a = n3.a AND t.b = n3.b AND t.c = n3.c
  LEFT JOIN n2 ab ON t.i >= 3 AND t.a = ab.b AND t.b = ab.c)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(sum(score), 0), 4) AS log_score,
       coalesce(sum(backed), 0)::BIGINT AS n_backoff
FROM d LEFT JOIN s USING (rid) GROUP BY rid, doc_id, len(w)
"""
