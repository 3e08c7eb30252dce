"""Exact top-k inner-product search with ball trees.

Rows are dealt evenly into shards; every shard gets a ball tree (centre, radius
and smallest id per node).  A query pops tree nodes in the order of their upper
bound ``q . centre + |q| * radius`` and stops when no node can beat its current
kth score.  Queries run in blocks, in two waves: first each block searches one
shard; the kth score and id it found there are handed to its searches of all the
other shards, which return only what is better.

Vectors become integers floor(256 * x) and scores are exact integers: float64
products where they stay below 2**53, 64-bit integers beyond.  Equal scores go
to the smaller id.  Nothing is sampled or cut off, so the result is exact.

Defined results: rows whose id is null, or whose vector is null, empty or holds a
null or non-finite component, take no part; vectors of different lengths are not
compared; repeated rows are candidates each; a candidate with the query's own id
is the query itself; empty tables give empty results.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpulse.llm.common import stored

SHARD_ROWS = 16384
QUERY_ROWS = 512
LEAF_ROWS = 256
NO_SCORE = -(2 ** 63)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, vec) with whole-number components; rows that take no part
    are left out."""
    valid = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & valid).select(
        F.col(id_col).cast("long").alias("vec_id"), F.size(vector_col).alias("dim"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vec"))


class BallTree:
    """Nodes in preorder; leaves are runs of the permuted rows."""

    def __init__(self, ids, vectors, centre, radius, first, child):
        self.ids, self.vectors = ids, vectors
        self.centre, self.radius, self.first, self.child = centre, radius, first, child

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> BallTree:
        centre, radius, first, child, order = [], [], [], [], []

        def grow(rows):
            node, points = len(centre), vectors[rows].astype(np.float64)
            middle = points.mean(0)
            away = np.sqrt(((points - middle) ** 2).sum(1))
            centre.append(middle)
            radius.append(away.max())
            first.append(ids[rows].min())
            child.append(None)
            if len(rows) <= leaf_rows or away.max() == 0:
                at = len(order)
                order.extend(rows.tolist())
                child[node] = (-1, at, len(order))
                return
            one = points[away.argmax()]
            other = points[((points - one) ** 2).sum(1).argmax()]
            along = np.argsort(points @ (other - one), kind="stable")
            half = len(rows) // 2
            left = len(centre)
            grow(rows[along[:half]])
            right = len(centre)
            grow(rows[along[half:]])
            child[node] = (left, right, 0)

        grow(np.argsort(ids, kind="stable"))
        return cls(ids[order], vectors[order], np.array(centre), np.array(radius), np.array(first), np.array(child))

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors, centre=self.centre, radius=self.radius,
                 first=self.first, child=self.child)
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> BallTree:
        with np.load(io.BytesIO(data)) as x:
            return cls(**{k: x[k] for k in ("ids", "vectors", "centre", "radius", "first", "child")})

    def search(self, query_ids, queries, k: int, score, owner):
        """Per query its best k rows that beat (score, owner), the kth so far.

        All queries of the block advance together: each pops its best node, and
        queries that popped the same leaf are scored with one product.
        """
        n = len(queries)
        exact = _exact_kind(queries, self.vectors)
        q, leaves = queries.astype(exact), self.vectors.astype(exact)
        qf = queries.astype(np.float64)
        length = np.sqrt((qf ** 2).sum(1))
        score, owner = score.astype(np.int64).copy(), owner.copy()
        best_score = np.full((n, k), NO_SCORE, np.int64)
        best_id = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        bound = np.full((n, len(self.radius)), -np.inf)  # of the nodes that are still to do
        bound[:, 0] = np.inf
        active = np.arange(n)
        while len(active):
            node = bound[active].argmax(1)
            top = bound[active, node]
            limit = score[active].astype(np.float64)
            # float bounds are widened, so that rounding never prunes
            slack = 1 + 1e-9 * np.abs(top, where=np.isfinite(top), out=np.zeros_like(top))
            beaten = (top + slack < limit) | (top == -np.inf)
            active, node = active[~beaten], node[~beaten]
            bound[active, node] = -np.inf
            for at in np.unique(node):
                asked = active[node == at]
                left, right, end = self.child[at]
                if left >= 0:
                    for c in (left, right):
                        bound[asked, c] = qf[asked] @ self.centre[c] + length[asked] * self.radius[c]
                    continue
                ids = self.ids[right:end]
                found = (q[asked] @ leaves[right:end].T).astype(np.int64)
                others = ids[None, :] != query_ids[asked][:, None]
                better = others & ((found > score[asked][:, None])
                                   | ((found == score[asked][:, None]) & (ids[None, :] < owner[asked][:, None])))
                for r in np.flatnonzero(better.any(1)):
                    a, new = asked[r], better[r]
                    s = np.concatenate([best_score[a], found[r][new]])
                    i = np.concatenate([best_id[a], ids[new]])
                    keep = np.lexsort((i, -s))[:k] if s.min() > NO_SCORE else _ranked(s, i, k)
                    best_score[a], best_id[a] = s[keep], i[keep]
                    if best_id[a, -1] != np.iinfo(np.int64).max:
                        score[a], owner[a] = best_score[a, -1], best_id[a, -1]
        return best_score, best_id


def _ranked(s, i, k):  # -s would overflow for the placeholder
    return np.lexsort((i, -(s.astype(np.float64)), s == NO_SCORE))[:k] if np.abs(s[s != NO_SCORE]).max(
        initial=0) < 2 ** 53 else np.array(sorted(range(len(s)), key=lambda j: (-int(s[j]), int(i[j])))[:k])


def _exact_kind(a, b):
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return np.float64 if most < 2 ** 53 else np.int64


def _vectors(column) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Stored table (dim, shard, tree): one ball tree per shard, of all rows."""
    shards = max(1, math.ceil(vectors.count() / shard_rows))

    def build(table: pa.Table) -> pa.Table:
        tree = BallTree.build(table.column("vec_id").to_numpy(), _vectors(table.column("vec")))
        return pa.table({"dim": table.column("dim")[:1], "shard": table.column("shard")[:1],
                         "tree": pa.array([tree.dumps()], pa.binary())})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, tree binary"), "ball_trees")


def _search(pairs_trees: DataFrame, pairs_queries: DataFrame, k: int) -> DataFrame:
    """Cogroup of (dim, shard, qblock): one tree with a block of queries."""
    def search(trees: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if trees.num_rows and queries.num_rows:
            tree = BallTree.loads(trees.column("tree")[0].as_py())
            ids = queries.column("vec_id").to_numpy()
            s, i = tree.search(ids, _vectors(queries.column("vec")), k, queries.column("kth_score").to_numpy(),
                               queries.column("kth_id").to_numpy())
            row, rank = np.nonzero(i != np.iinfo(np.int64).max)
            out = {"query_id": ids[row], "vec_id": i[row, rank], "score": s[row, rank]}
        return pa.table({name: pa.array(v, pa.int64()) for name, v in out.items()})

    keys = ("dim", "shard", "qblock")
    return pairs_trees.groupBy(*keys).cogroup(pairs_queries.groupBy(*keys)).applyInArrow(
        search, "query_id long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k best other rows of every distinct query row: query_id, rank (from
    1), vec_id, score."""
    vectors = stored(integer_vectors(rows, id_col, vector_col), "vectors")
    index = build_index(vectors, shard_rows)
    queries = vectors.filter(is_query).dropDuplicates(["vec_id", "dim", "vec"])
    blocks = max(1, math.ceil(queries.count() / query_rows))
    queries = stored(queries.withColumn("qblock", F.pmod(F.xxhash64(F.lit("q"), "vec_id"), F.lit(blocks)).cast("int")),
                     "vector_queries")
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    home = F.pmod(F.col("qblock"), F.lit(shards)).cast("int")
    all_blocks = index.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    none = {"kth_score": F.lit(NO_SCORE).cast("long"), "kth_id": F.lit(2 ** 63 - 1).cast("long")}

    first = stored(_top(_search(all_blocks.filter(F.col("shard") == home),
                                queries.withColumn("shard", home).withColumns(none), k), k), "top_first")
    if shards == 1:
        return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    kth = first.filter(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("k_score"), F.col("vec_id").alias("k_id"))
    seeded = (queries.join(kth, "vec_id", "left")
              .withColumn("kth_score", F.coalesce("k_score", none["kth_score"]))
              .withColumn("kth_id", F.coalesce("k_id", none["kth_id"])).drop("k_score", "k_id")
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
              .filter(F.col("shard") != home))
    rest = _search(all_blocks.filter(F.col("shard") != home), seeded, k)
    return _top(first.drop("rank").unionByName(rest), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_balltree_topk(spark, sf_dir: str) -> DataFrame:
    """Five best inner products of every 50th vector against all others."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, F.col("vec_id") % 50 == 0)


ORACLE_OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
