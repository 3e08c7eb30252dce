"""Merkle manifest of a table: every row's leaf, a tree per partition value, one
root, and a checked proof for every row.

Trees can be far larger than a task.  Leaves are numbered inside their tree by a
distributed sort and cut into superblocks of ``FAN`` consecutive leaves.  Upwards,
every superblock becomes one node of the next round, until each tree has one.
Downwards, a superblock's nodes are cogrouped with the *outer* row of their
superblock (the sibling digests from that superblock's root to the top), and one
function finishes the local reduction, joins local and outer siblings to whole
proofs and folds them.  A task holds ``FAN`` nodes and one outer row per group,
whatever the table's size or the largest tree's share.

Defined results: null values are encoded apart from empty ones; a null partition
value is a tree of its own, the first one; rows with equal ids are ordered by their
leaves, so copies of a row are leaves of their own with proofs of their own; null
ids come first and are never tampered with; an empty table gives no rows.  Other
columns of the table are neither read nor returned.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpulse.llm.common import stored, table
from reelpulse.operators.ranking import ranked

#: Nodes of a superblock, a power of two.
LEVELS = 10
FAN = 1 << LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, pos long, size long, digest string"
OUTER = "tree string, pos long, path string, subroot string, root string"
RESULT = ("doc_id {id}, tree string, leaf string, subroot string, root string, n_siblings int, proof_sha256 string, "
          "folded_root string, verified boolean")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, ``:`` and the value's text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return F.sha2(F.concat(*(encoded(changed.get(c, F.col(c))) for c in FIELDS)), 256)


def levels_of(size: int, levels: int) -> int:
    """Levels that a superblock reduces in a tree of ``size`` nodes: all of them
    below further superblocks, else until one node remains."""
    return min(levels, (size - 1).bit_length())


def local_tree(digests: list[str], levels: int) -> list[list[str]]:
    """The levels of one superblock; a last node alone is hashed alone."""
    tree = [digests]
    for _ in range(levels):
        row = tree[-1]
        tree.append([sha("".join(row[i:i + 2])) for i in range(0, len(row), 2)])
    return tree


def local_path(tree: list[list[str]], at: int) -> str:
    """One letter per level: R or L and the sibling on that side, or S for none."""
    parts = []
    for row in tree[:-1]:
        other = at ^ 1
        parts.append("S" if other >= len(row) else ("R" if other > at else "L") + row[other])
        at >>= 1
    return "".join(parts)


def siblings(path: str) -> list[tuple[str, str]]:
    """(side, digest) of each level of a path; the digest of S is empty."""
    out, at = [], 0
    while at < len(path):
        width = 0 if path[at] == "S" else 64
        out.append((path[at], path[at + 1:at + 1 + width]))
        at += 1 + width
    return out


def folded(digest: str, steps: list[tuple[str, str]]) -> str:
    for side, other in steps:
        digest = sha(other + digest if side == "L" else digest + other)
    return digest


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", levels))


def _reduce(nodes: DataFrame, levels: int) -> DataFrame:
    """One node per superblock."""
    def root_of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        size = int(part["size"].iloc[0])
        top = local_tree(part["digest"].tolist(), levels_of(size, levels))[-1][0]
        return pd.DataFrame({"tree": [part["tree"].iloc[0]], "pos": [int(part["block"].iloc[0])],
                             "size": [-(-size >> levels)], "digest": [top]})

    return _blocks(nodes, levels).groupBy("tree", "block").applyInPandas(root_of, NODE)


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The node tables from the leaves to one node per tree."""
    rounds, largest = [nodes], nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        rounds.append(stored(_reduce(rounds[-1], levels), "merkle_nodes"))
        largest = -(-largest >> levels)
    return rounds


def _expand(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Outer rows of the nodes themselves, from those of their superblocks."""
    def paths(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        tree = local_tree(part["digest"].tolist(), levels_of(int(part["size"].iloc[0]), levels))
        rest = above.iloc[0]
        return pd.DataFrame({"tree": part["tree"], "pos": part["pos"],
                             "path": [local_path(tree, i) + rest["path"] for i in range(len(part))],
                             "subroot": rest["subroot"], "root": rest["root"]})

    return (_blocks(nodes, levels).groupBy("tree", "block")
            .cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))
            .applyInPandas(paths, OUTER))


def _finish(leaves: DataFrame, outer: DataFrame, levels: int, id_type: str) -> DataFrame:
    """Whole proofs of the leaves and their folds."""
    def prove(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        tree = local_tree(part["digest"].tolist(), levels_of(int(part["size"].iloc[0]), levels))
        rest = above.iloc[0]
        outside = siblings(rest["path"])
        proofs = [siblings(local_path(tree, i)) + outside for i in range(len(part))]
        fold = [folded(d, p) for d, p in zip(part["shown"], proofs, strict=True)]
        return pd.DataFrame({
            "doc_id": part["doc_id"], "tree": part["tree"], "leaf": part["digest"],
            "subroot": rest["subroot"], "root": rest["root"],
            "n_siblings": [sum(side != "S" for side, _ in p) for p in proofs],
            "proof_sha256": [sha("".join(d for _, d in p)) for p in proofs],
            "folded_root": fold, "verified": [f == rest["root"] for f in fold]})

    return (_blocks(leaves, levels).groupBy("tree", "block")
            .cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))
            .applyInPandas(prove, RESULT.format(id=id_type)))


def manifest(docs: DataFrame, shown: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, lang, leaf, its tree's subroot, the root, n_siblings,
    proof_sha256, folded_root and verified.

    ``shown`` is the leaf digest that a holder of the row would present (default:
    the row's own); ``folded_root`` folds it along the proof."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # ids travel as text: a nullable integer column is not an integer in pandas
    leaves = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit(":"), F.col("lang")), F.lit("-")).alias("tree"),
        leaf_digest().alias("digest"), (leaf_digest() if shown is None else shown).alias("shown"))
    leaves = ranked(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest")], by=["tree"], rank_col="pos", size_col="size")
    leaves = stored(leaves.withColumn("doc_id", F.col("doc_id").cast("string")), "merkle_leaves")
    rounds = _rounds(leaves.select("tree", "pos", "size", "digest"), levels)
    subroots = rounds[-1].select(F.col("tree").alias("lang_tree"), F.col("digest"))
    tops = stored(ranked(subroots, [F.col("lang_tree")], rank_col="pos", size_col="size")
                  .withColumn("tree", F.lit("")), "merkle_subroots")
    upper = _rounds(tops.select("tree", "pos", "size", "digest"), levels)
    outer = upper[-1].select("tree", "pos", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for nodes in upper[-2::-1]:
        outer = stored(_expand(nodes, outer, levels), "merkle_outer")
    outer = tops.join(outer, "pos").select(
        F.col("lang_tree").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")
    for nodes in rounds[-2:0:-1]:
        outer = stored(_expand(nodes, outer, levels), "merkle_outer")
    proved = _finish(leaves, outer, levels, "string")
    return proved.select(
        F.col("doc_id").cast(id_type).alias("doc_id"),
        F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")).alias("lang"),
        *(c for c in proved.columns if c not in ("doc_id", "tree")))


def tampered_digest(every: int = 7) -> Column:
    """The leaf that a holder presents who adds 1 to n_chars in the rows whose
    crc32 of the decimal id is divisible by ``every``."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return F.when(touched, leaf_digest(n_chars=more)).otherwise(leaf_digest())


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Manifest and checked proofs of all documents, some of them tampered with."""
    return manifest(table(spark, sf_dir, "documents"), tampered_digest())


def _sql_field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"COALESCE(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


# CRC-32 of a decimal id, bit by bit (the reflected polynomial 0xEDB88320).
_SQL_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
        range(1, length(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

ORACLE_OP13 = f"""
WITH RECURSIVE leaves AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        ROW_NUMBER() OVER () AS r
    FROM (SELECT doc_id, lang, COALESCE(':' || lang, '-') AS tree, {_sql_leaf('n_chars')} AS leaf,
            CASE WHEN {_SQL_CRC} % 7 = 0 THEN {_sql_leaf('n_chars + 1')} ELSE {_sql_leaf('n_chars')} END AS shown
        FROM documents)),
nodes AS (
    SELECT tree, 0 AS level, pos, COUNT(*) OVER (PARTITION BY tree) AS n, leaf AS h FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(h || COALESCE(follower, ''))
    FROM (SELECT *, LEAD(h) OVER (PARTITION BY tree ORDER BY pos) AS follower FROM nodes WHERE n > 1) WHERE pos % 2 = 0),
subroots AS (SELECT tree, h, ROW_NUMBER() OVER (ORDER BY tree) - 1 AS top_pos FROM nodes WHERE n = 1),
tops AS (
    SELECT 0 AS level, top_pos AS pos, COUNT(*) OVER () AS n, h FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(h || COALESCE(follower, ''))
    FROM (SELECT *, LEAD(h) OVER (ORDER BY pos) AS follower FROM tops WHERE n > 1) WHERE pos % 2 = 0),
steps AS (
    SELECT l.r, v.level AS k, (l.pos >> v.level) % 2 AS is_right, s.h AS sibling
    FROM leaves l JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) v ON v.tree = l.tree
    LEFT JOIN nodes s ON s.tree = l.tree AND s.level = v.level AND s.pos = xor(l.pos >> v.level, 1)
    UNION ALL
    SELECT l.r, 1000 + v.level, (t.top_pos >> v.level) % 2, s.h
    FROM leaves l JOIN subroots t ON t.tree = l.tree CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) v
    LEFT JOIN tops s ON s.level = v.level AND s.pos = xor(t.top_pos >> v.level, 1)),
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY r ORDER BY k) AS step FROM steps),
fold AS (
    SELECT r, 0 AS step, shown AS h FROM leaves
    UNION ALL
    SELECT f.r, n.step, sha256(CASE WHEN n.is_right = 1 THEN n.sibling || f.h ELSE f.h || COALESCE(n.sibling, '') END)
    FROM fold f JOIN numbered n ON n.r = f.r AND n.step = f.step + 1),
proofs AS (SELECT r, sha256(COALESCE(STRING_AGG(sibling, '' ORDER BY step), '')) AS proof_sha256,
        CAST(COUNT(sibling) AS INTEGER) AS n_siblings, MAX(step) AS last_step FROM numbered GROUP BY r)
SELECT l.doc_id, l.lang, l.leaf, t.h AS subroot, top.h AS root, COALESCE(p.n_siblings, 0) AS n_siblings,
    COALESCE(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = top.h AS verified
FROM leaves l JOIN subroots t ON t.tree = l.tree CROSS JOIN (SELECT h FROM tops WHERE n = 1) top
LEFT JOIN proofs p ON p.r = l.r JOIN fold f ON f.r = l.r AND f.step = COALESCE(p.last_step, 0)
"""
