"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their shingle sets reaches a
threshold t.  A global order puts rare shingles first.  A set of n shingles that
links with another shares at least ceil(t n) of them, so with a prefix of
``n - ceil(t n) + l`` shingles on both sides at least ``l`` shared shingles lie
in the two prefixes.  Each document picks its own ``l``: lengthening the prefix
adds list entries to read, but demands ``l`` shared ones before a pair is
verified.  Both are estimated from the frequencies of its shingles and the
cheapest ``l`` is taken.  Two documents with l1 and l2 must share min(l1, l2).

Steps:

1. One pass over whole texts: set size and 128-bit fingerprint of every document,
   and a hashed frequency table (counters by the amount of text, up to a bound) of
   the shingles of all documents.  Equal fingerprints make a class with one representative.
2. A second pass emits every document's prefix.  Shingles that are in only one
   fingerprint's prefix are dropped; the rest are the inverted lists.  Of two
   documents, the one whose prefix ends first in the global order has its dropped
   shingles to itself (the other's prefix reaches past them), so they bound what
   the two can share.  The other's dropped ones say nothing about the pair.
3. Lists of many near copies would yield all pairs within a group.  So first
   each list is verified only against one of its documents (its pivot), in a few
   rounds with other pivots; documents that link get a common label, and lists
   whose documents all have one label need no more work.
4. What is left is joined in full: on every list, documents whose label is not
   the list's most frequent one against all documents of other labels, shared
   entries counted, and pairs with enough of them verified exactly.  Sizes, the
   dropped shingles and parity bits of the sets rule out most pairs inside the
   join.

No candidate is dropped: a pair that is never compared lies in one component
already.  Links found inside a component are therefore a spanning set of it, not
all its pairs.  Shingles are told apart by 64-bit hashes.

Defined results: texts that are null or without words have no shingles and link
with nothing; rows with a null id link with nothing and have a null component;
rows with equal ids are one node; repeated rows each give their row; empty
tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from reelpulse.llm.common import among, drop_stored, shuffles_dropped, small_batches, stored, without
from reelpulse.llm.components import star_edges, star_nodes
from reelpulse.llm.ngrams import shingle_sets, slices

WORDS = 5
PERCENT = 75
#: Counters of the hashed frequency table (4 bytes each, sent to every task): one for
#: every so many bytes of text, between two powers of two.
COUNTER_TEXT = 64
LEAST_BITS, MOST_COUNTER_BITS = 16, 22
CHUNK, CHUNK_BATCH = 4096, 512
#: Parity bits of a set by its size, and of larger ones.
BITS, MOST_BITS = ((96, 256), (200, 512)), 1024
#: Largest l, and the cost of verifying a pair in list entries.
MAX_MATCH = 8
VERIFY_COST = 8.0
#: Pivot rounds at most (they also end when a round no longer halves the work of
#: the full join), and the list entries of the full join per entry of the lists at
#: which pivots are no longer worth another round.
PIVOT_ROUNDS = 4
FULL_JOIN_COST = 4
#: What a list entry has of its document.
ENTRY = ("n", "l", "cap", "end_count", "end_hash")


def needed(n, percent: int = PERCENT):
    """ceil(t n): shingles of a set of n that a linked set shares at least."""
    return -(-percent * n // 100)


def choose_prefix(estimates: np.ndarray, percent: int = PERCENT) -> tuple[int, int]:
    """(l, prefix length) for a set whose shingles, in global order, have these
    estimated numbers of other documents."""
    n = len(estimates)
    need = needed(n, percent)
    entries = np.cumsum(estimates)
    ls = np.arange(1, min(MAX_MATCH, need) + 1)
    lengths = n - need + ls
    read = lengths + entries[lengths - 1]
    pairs = entries[lengths - 1] / ls
    best = int(np.argmin(read + VERIFY_COST * pairs))
    return int(ls[best]), int(lengths[best])


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """256 to 1024 bits as longs, more for larger sets; a bit is the parity of
    the shingles that fall on it.  Two sets' bits, if equally many, differ in at
    most as many places as the sets do."""
    size = next((bits for most, bits in BITS if len(shingles) <= most), MOST_BITS)
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def counter_bits(docs: DataFrame) -> int:
    """Size of the frequency table: more text, more counters, up to a bound."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return min(max((size // COUNTER_TEXT).bit_length(), LEAST_BITS), MOST_COUNTER_BITS)


def signatures(docs: DataFrame, bits: int, words: int = WORDS) -> DataFrame:
    """Stored rows: doc_id, n, k1, k2 of every document, and the partial
    frequency tables of the tasks as (task, chunk, counts) rows (two bytes a
    counter, which saturate)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def read(batches):
        counters = np.zeros(1 << bits, np.uint32)
        id_kind = None
        names = ["doc_id", "n", "k1", "k2", "task", "chunk", "counts"]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            id_kind = batch.schema.field(0).type
            sizes, keys = [], []
            for i, j in slices(texts):
                sets = shingle_sets(texts[i:j], words)
                if sets:
                    at = (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64)
                    np.add.at(counters, at, 1)
                sizes += [len(s) for s in sets]
                keys += [xxh3_128_digest(s.tobytes()) for s in sets]
            two = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            none = [None] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1]),
                 pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], names=names)
        if id_kind is not None:
            task = TaskContext.get().partitionId()
            small = np.minimum(counters, 65535).astype(np.uint16)
            chunks = [c for c in range(len(small) // CHUNK) if small[c * CHUNK:(c + 1) * CHUNK].any()]
            for i in range(0, len(chunks), CHUNK_BATCH):
                part = chunks[i:i + CHUNK_BATCH]
                none = [None] * len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(none, id_kind), *[pa.array(none, pa.int64())] * 3,
                     pa.array([task] * len(part), pa.int32()), pa.array(part, pa.int32()),
                     pa.array([small[c * CHUNK:(c + 1) * CHUNK].tobytes() for c in part], pa.binary())], names=names)

    with small_batches(docs.sparkSession):
        return stored(docs.mapInArrow(
            read, f"doc_id {id_type}, n long, k1 long, k2 long, task int, chunk int, counts binary"), "signatures")


def frequency_table(rows: DataFrame, bits: int) -> np.ndarray:
    """Sum of the partial tables, chunk by chunk as they come, so that a task holds
    only the sums of its chunks."""
    def add(batches):
        totals = {}
        for batch in batches:
            for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total = totals.setdefault(chunk, np.zeros(CHUNK, np.uint64))
                total += np.frombuffer(part.as_buffer(), np.uint16)
        yield pa.RecordBatch.from_arrays(
            [pa.array(totals, pa.int32()),
             pa.array([np.minimum(t, 2 ** 32 - 1).astype(np.uint32).tobytes() for t in totals.values()], pa.binary())],
            names=["chunk", "counts"])

    out = np.zeros(1 << bits, np.uint32)
    with small_batches(rows.sparkSession), shuffles_dropped(rows.sparkSession):
        summed = (rows.filter("chunk is not null").select("chunk", "counts").repartition("chunk")
                  .mapInArrow(add, "chunk int, counts binary"))
        # 2**bits / CHUNK rows, 16 MB at most; all at once, as an iterator runs a job for each partition
        for row in summed.collect():
            out[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], np.uint32)
    return out


def prefixes(docs: DataFrame, counters: np.ndarray, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Stored rows (k1, n, l, shingles, bits, end_count, end_hash): the prefix of
    every document that has shingles, k1 being the first half of its fingerprint,
    and the place in the global order where the prefix ends."""
    noise = np.float32(counters.mean())  # chance share of any counter
    bits = len(counters).bit_length() - 1

    def emit(batches):
        for batch in batches:
            texts = [t for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                     if i is not None]
            for i, j in slices(texts):
                rows = []
                for s in shingle_sets(texts[i:j], words):
                    if not len(s):
                        continue
                    counted = counters[(s >> np.uint64(64 - bits)).astype(np.int64)]
                    signed = s.view(np.int64)  # hashes compare as longs, as in Spark
                    order = np.lexsort((signed, counted))
                    l, length = choose_prefix(np.maximum(counted[order] - noise, 0), percent)
                    rows.append((int.from_bytes(xxh3_128_digest(s.tobytes())[:8], "little", signed=True),
                                 len(s), l, signed[order[:length]], parity_bits(s).tolist(),
                                 int(counted[order[length - 1]]), int(signed[order[length - 1]])))
                flat = np.concatenate([r[3] for r in rows]) if rows else np.zeros(0, np.int64)
                offsets = np.cumsum([0, *[len(r[3]) for r in rows]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.array([r[2] for r in rows], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                     pa.array([r[5] for r in rows], pa.int64()), pa.array([r[6] for r in rows], pa.int64())],
                    names=["k1", "n", "l", "shingles", "bits", "end_count", "end_hash"])

    with small_batches(docs.sparkSession):
        return stored(docs.mapInArrow(emit, "k1 long, n int, l int, shingles array<long>, bits array<long>, "
                                            "end_count long, end_hash long"), "prefixes")


def _dealt(entries: DataFrame) -> DataFrame:
    """List entries dealt by their shingle, so that an aggregate by list and an inner
    join with it read one exchange.  No entry has nulls; it is said here as Spark
    would else add it below one of the two only, and shuffle twice."""
    return entries.filter(" and ".join(f"{c} is not null" for c in entries.columns)).repartition("shingle")


def inverted_lists(prefix_rows: DataFrame, classes: DataFrame,
                   percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Stored lists (shingle, rep, n, l, cap, end_count, end_hash) of the shingles
    that at least two different fingerprints have in their prefixes, and stored
    (rep, bits) of their documents.

    ``cap`` is a document's set less the shingles that are in its prefix only: the
    most that it can share with a document whose prefix does not end before its
    own.  With one whose prefix ends earlier it can share more, so a small cap
    alone takes no document off the lists.  A list entry stays unless its cap is
    too small for a link and no other document of the list with a sufficient cap
    ends earlier: such an entry is in no pair that ``_may_link`` passes.
    """
    entries = _dealt(prefix_rows.select(F.explode("shingles").alias("shingle"), "k1"))
    shared = (entries.groupBy("shingle").agg(F.min("k1").alias("a"), F.max("k1").alias("b"))
              .filter("a <> b").select("shingle"))
    kept = stored(entries.join(shared, "shingle").distinct(), "list_entries")
    # all rows of a fingerprint have the same prefix
    held = prefix_rows.groupBy("k1").agg(F.min(F.struct(
        "n", "l", F.size("shingles").alias("length"), "end_count", "end_hash", "bits")).alias("p")).select("k1", "p.*")
    cap = F.col("n") - F.col("length") + F.size("shingles")
    holders = stored(
        kept.groupBy("k1").agg(F.collect_list("shingle").alias("shingles")).join(held, "k1")
        .join(classes.select("k1", "rep"), "k1").select(
            "k1", "rep", "n", "l", cap.cast("int").alias("cap"), "end_count", "end_hash", "shingles", "bits"), "holders")
    drop_stored(prefix_rows, kept)
    every = _dealt(holders.select(F.explode("shingles").alias("shingle"), "rep", *ENTRY)).distinct()
    end, able = F.struct("end_count", "end_hash"), 100 * F.col("cap") >= percent * F.col("n")
    earliest = (every.groupBy("shingle").agg(F.min(F.when(able, end)).alias("earliest"))
                .filter("earliest is not null"))
    lists = stored(every.join(earliest, "shingle").filter(able | (end > F.col("earliest")))
                   .select("shingle", "rep", *ENTRY), "lists")
    # an id with several texts stands for several sets: no parity bound for it
    bits = stored(holders.groupBy("rep").agg(
        F.when(F.min("k1") == F.max("k1"), F.min("bits")).alias("bits")), "bits")
    drop_stored(holders)
    return lists, bits


def whole_sets(docs: DataFrame, ids: DataFrame, words: int = WORDS) -> DataFrame:
    """Stored (rep, shingles): the whole sets of the documents in ``ids``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def compute(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in slices(texts):
                sets = shingle_sets(texts[i:j], words)
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["rep", "shingles"])

    with small_batches(docs.sparkSession):
        return stored(among(docs, ids, "doc_id").select("doc_id", "text")
                      .mapInArrow(compute, f"rep {id_type}, shingles array<long>"), "sets")


def verified(pairs: DataFrame, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs whose whole sets are similar enough, stored.  Only
    documents of some pair are cut into shingles again."""
    pairs = stored(pairs, "pairs")
    ids = stored(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct(), "pair_ids")
    sets = whole_sets(docs, ids, words)
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    links = stored(both.filter(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared))
                   .select("a", "b").distinct(), "links")
    drop_stored(sets, pairs, ids)
    return links


def _may_link(mine, other, percent, apart=None):
    """Whether two sets can share enough, by their sizes, the cap of the one whose
    prefix ends first (the other's cap is no bound for the pair) and, where
    given, the places in which their parity bits differ.  ``mine`` and ``other``
    are the prefixes of their columns' names."""
    n, cap, *end = (F.col(mine + c) for c in ("n", "cap", "end_count", "end_hash"))
    other_n, other_cap, *other_end = (F.col(other + c) for c in ("n", "cap", "end_count", "end_hash"))
    first = (end[0] < other_end[0]) | ((end[0] == other_end[0]) & (end[1] <= other_end[1]))
    most = F.least(F.when(first, cap).otherwise(other_cap), n, other_n)
    if apart is not None:
        most = F.least(most, F.floor((n + other_n - apart) / 2))
    return 100 * most >= percent * (n + other_n - most)


def pivot_pairs(lists: DataFrame, seed: int, percent: int) -> DataFrame:
    """Stored candidates of every open list with one of its documents.

    ``lists`` has a label; a list with one label only is closed.  The first
    round's pivot is the document with the least part of its set to itself, the
    others' the one with the least hash; lists with much the same documents pick
    the same one.
    """
    own = F.round((F.col("n") - F.col("cap")) / F.col("n"), 3) if seed == 0 else F.lit(0.0)
    lists = _dealt(lists)
    pivots = (
        lists.groupBy("shingle").agg(
            F.min(F.struct(own.alias("own"), F.xxhash64(F.lit(seed), "rep").alias("h"), F.col("rep").alias("pivot"),
                           *[F.col(c).alias("p" + c) for c in (*ENTRY, "label")])).alias("p"),
            F.min("label").alias("first"), F.max("label").alias("last"))
        .filter("first <> last").select("shingle", "p.pivot", *[f"p.p{c}" for c in (*ENTRY, "label")]))
    return stored(
        lists.join(pivots, "shingle")
        .filter((F.col("label") != F.col("plabel")) & _may_link("", "p", percent))
        .groupBy(F.col("rep").alias("a"), F.col("pivot").alias("b"))
        .agg(F.count("*").alias("hits"), F.min(F.least("l", "pl")).alias("l"))
        .filter("hits >= l").select("a", "b"), "pivot_pairs")


def open_entries(lists: DataFrame) -> DataFrame:
    """Stored entries of the lists with several labels, each with the list's size
    and its most frequent label, ``main``."""
    lists = _dealt(lists)
    found = (lists.groupBy("shingle", "label").agg(F.count("*").alias("k")).groupBy("shingle").agg(
        F.sum("k").alias("size"), F.max(F.struct("k", "label")).alias("top"), F.count("*").alias("labels"))
        .filter("labels > 1").select("shingle", "size", F.col("top.label").alias("main")))
    return stored(lists.join(found, "shingle").select("shingle", "rep", *ENTRY, "label", "size", "main"), "open_lists")


def full_pairs(opened: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Stored candidates of different labels on the open lists, with all their
    shared entries counted: of any two such documents on a list, at least one is
    not of its main label."""
    n_bits = MOST_BITS // 64
    longs = [F.coalesce(F.get("bits", F.lit(i)), F.lit(0)).alias(f"bits{i}") for i in range(n_bits)]
    entries = stored(
        opened.join(bits, "rep")
        .select("shingle", "rep", *ENTRY, "label", "main", F.size("bits").alias("n_bits"), *longs), "open_entries")

    def side(prefix, rows):
        return rows.select("shingle", *[F.col(c).alias(f"{prefix}_{c}") for c in rows.columns if c != "shingle"])

    minor, other = side("a", entries.filter("label <> main")), side("b", entries)
    differ = sum((F.bit_count(F.col(f"a_bits{i}").bitwiseXOR(F.col(f"b_bits{i}"))) for i in range(n_bits)), F.lit(0))
    apart = F.when(F.col("a_n_bits") == F.col("b_n_bits"), differ).otherwise(0)
    pairs = stored(
        minor.join(other, "shingle")
        .filter((F.col("a_label") != F.col("b_label"))
                & ((F.col("b_label") == F.col("b_main")) | (F.col("a_rep") < F.col("b_rep")))
                & _may_link("a_", "b_", percent) & _may_link("a_", "b_", percent, apart))
        .groupBy(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"))
        .agg(F.count("*").alias("hits"), F.min(F.least("a_l", "b_l")).alias("l"))
        .filter("hits >= l").select("a", "b"), "full_pairs")
    drop_stored(entries)
    return pairs


def labelled(lists: DataFrame, stars: DataFrame | None) -> DataFrame:
    """``lists`` with the component of every document as its label."""
    plain = lists.select("shingle", "rep", *ENTRY)
    if stars is None:
        return plain.withColumn("label", F.col("rep"))
    found = star_nodes(stars)
    return stored(plain.join(found, plain["rep"] == found["node"], "left").select(
        "shingle", "rep", *ENTRY, F.coalesce("component", "rep").alias("label")), "lists")


def jaccard_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has doc_id, n_shingles and rep (the class of
    equal sets; null without shingles or id), one row per row of ``docs``; links
    are verified pairs (a, b) of representatives that span every component."""
    members, links, _ = _linked(docs, words, percent)
    return members, links


def _linked(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members and links, and edges with the same components as the links: the
    stars of the pivot rounds and the links found after them."""
    docs = docs.select(F.col("doc_id"), F.col("text"))
    width = counter_bits(docs)
    rows = signatures(docs, width, words)
    known = stored(rows.filter("chunk is null").select("doc_id", "n", "k1", "k2"), "fingerprints")
    classes = stored(known.filter("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep")), "classes")
    counters = frequency_table(rows, width)
    drop_stored(rows)
    lists, bits = inverted_lists(prefixes(docs, counters, words, percent), classes, percent)

    links, stars, lists = None, None, labelled(lists, None)
    entries, before = max(lists.count(), 1), None
    for seed in range(PIVOT_ROUNDS):
        found = verified(pivot_pairs(lists, seed, percent), docs, words, percent)
        links = found if links is None else links.unionByName(found)
        stars = star_edges(found if stars is None else stars.unionByName(found))
        older, lists = lists, labelled(lists, stars)
        drop_stored(older)
        opened = open_entries(lists)
        left = opened.filter("label <> main").agg(F.sum("size")).first()[0] or 0
        if left <= FULL_JOIN_COST * entries or (before is not None and 2 * left > before):
            break
        before = left
        if seed + 1 < PIVOT_ROUNDS:
            drop_stored(opened)
    drop_stored(lists)
    edges = stars
    if left:
        found = verified(full_pairs(opened, bits, percent), docs, words, percent)
        links, edges = links.unionByName(found), stars.unionByName(found)
    drop_stored(opened, bits)
    members = known.join(classes, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"))
    return members, links, edges


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, rep, component_id (the
    smallest id reachable by links, its own without any)."""
    members, _, edges = _linked(docs, words, percent)
    members = stored(members, "members")
    # rows with one id are one node, whatever their texts
    first = members.filter("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    several = first.filter("a <> b").select("doc_id", "a")
    shared_ids = members.join(several, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))
    found = star_nodes(star_edges(edges.unionByName(shared_ids)))
    return members.join(found, members["rep"] == found["node"], "left").select(
        "doc_id", "n_shingles", "rep", F.coalesce("component", "rep", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document per component: the one with the component's
    id.  Rows with a null id and rows without shingles all stay; of repeated
    rows with the kept id, all stay too."""
    copies = near_duplicates(docs, words, percent).filter("component_id <> doc_id").select("doc_id")
    return without(docs, copies, [F.col("doc_id")])


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of near-equal documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


ORACLE_OP1 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * k >= 75 * (na.n + nb.n - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(node, seen) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT b, seen FROM reach JOIN both_ways ON a = node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) r USING (doc_id)
"""
