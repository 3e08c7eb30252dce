"""Token ids packed into fixed-length rows, as binary columns.

Documents are encoded, cut losslessly into pieces of at most ``seq_len`` tokens,
and packed best-fit decreasing: the longest piece first, each into the open row
with the least room that still takes it.  That row is found with a segment tree
over the remaining capacities.  Each output row holds the padded id vector, the
cumulative segment lengths and position ids that restart at 0 in every segment.

Packing works inside a task on runs of a bounded number of tokens, so nothing is
shuffled, memory does not depend on the input, and a lost task can be run again
alone.

Defined results: null and empty texts have no tokens and appear in no row;
repeated rows are packed each; pieces of one document keep their number, so the
documents can be put together again (see ``unpacked``).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from reelpulse.llm.token_count import VOCABULARY, read_vocabulary

SEQ_LEN = 2048
RUN_TOKENS = 4_000_000
#: Rows of a result batch, and the longest match of SPLIT in a text that the encoder
#: cannot take whole.
BATCH_ROWS = 256
MAX_UNBROKEN = 1000
# Fixed value: how the vocabulary's tokenizer splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PATTERN = regex.compile(SPLIT)
# A text without such a run has no match that is too long.
UNBROKEN = re.compile(r"[^ \t\n\r\x0b\x0c]{%d}|\s{%d}" % (MAX_UNBROKEN, MAX_UNBROKEN))
SCHEMA = ("pack_id long, n_tokens int, doc_ids array<{id}>, pieces array<int>, cu_seqlens array<int>, "
          "token_ids binary, position_ids binary")


class Capacities:
    """Open rows by remaining capacity; a segment tree counts them."""

    def __init__(self, top: int):
        self.leaves = 1
        while self.leaves <= top:
            self.leaves *= 2
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(top + 1)]

    def _add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.tree[node] += n
            node //= 2

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of an open row with the least capacity >= need."""
        tree, node = self.tree, self.leaves + need
        while not tree[node]:
            while node & 1:  # a right child: nothing further right below its parent
                node //= 2
                if not node:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not tree[node]:
                node += 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Rows of piece indexes, best-fit decreasing."""
    rows: list[list[int]] = []
    room = Capacities(seq_len)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = room.take(lengths[i])
        if found is None:
            found = seq_len, len(rows)
            rows.append([])
        capacity, row = found
        rows[row].append(i)
        if capacity > lengths[i]:
            room.put(capacity - lengths[i], row)
    return rows


def bounded_parts(text: str) -> list[str]:
    """``text`` in parts without a match of SPLIT over MAX_UNBROKEN characters.  Cuts are where matches
    meet and inside the too long ones only, so every other match is encoded as in
    the whole text."""
    if len(text) <= MAX_UNBROKEN or not UNBROKEN.search(text):
        return [text]
    parts, start, before = [], 0, ""
    for match in PATTERN.finditer(text):
        if len(match[0]) > MAX_UNBROKEN:
            # white space is split by what follows it, so the match before stays alone
            last = match.start() - len(before) if before.isspace() else match.start()
            cuts = [start, last, *range(match.start(), match.end(), MAX_UNBROKEN), match.end()]
            parts += [text[i:j] for i, j in zip(cuts, cuts[1:], strict=False) if i < j]
            start = match.end()
            before = ""
        else:
            before = match[0]
    if start < len(text):
        parts.append(text[start:])
    return parts


def encoded(encoder, text: str) -> np.ndarray:
    """Ids of a whole text.  The encoder's pattern engine gives up on hundreds of
    thousands of blanks in a row; only such a text is encoded in parts."""
    try:
        return encoder.encode_to_numpy(text)
    except ValueError:
        return np.concatenate([encoder.encode_to_numpy(p) for p in bounded_parts(text)])


def make_encoder(vocabulary: list[bytes]):
    import tiktoken

    return tiktoken.Encoding("corpus", pat_str=SPLIT, mergeable_ranks={p: i for i, p in enumerate(vocabulary)},
                             special_tokens={})


def packed(docs: DataFrame, vocabulary_path: str = VOCABULARY, seq_len: int = SEQ_LEN,
           run_tokens: int = RUN_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows: pack_id, n_tokens, doc_ids and pieces (one entry per
    segment), cu_seqlens (from 0), token_ids (little-endian, two bytes an id when
    the vocabulary allows it, padded with the first free id) and position_ids
    (four bytes each)."""
    vocabulary = read_vocabulary(vocabulary_path)
    pad = len(vocabulary)
    id_kind = np.dtype("<u2") if pad < 65536 else np.dtype("<u4")
    id_type = docs.schema[id_col].dataType

    def pack(batches):
        encoder = make_encoder(vocabulary)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        arrow_id, made = None, 0
        keys: list[tuple] = []
        pieces: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal made, held
            rows = best_fit([len(p) for p in pieces], seq_len)
            for at in range(0, len(rows), BATCH_ROWS):
                out = rows[at:at + BATCH_ROWS]
                ids = np.full((len(out), seq_len), pad, id_kind)
                positions = np.zeros((len(out), seq_len), "<u4")
                ends = []
                for r, row in enumerate(out):
                    sizes = [len(pieces[i]) for i in row]
                    cu = np.concatenate([[0], np.cumsum(sizes)])
                    ids[r, :cu[-1]] = np.concatenate([pieces[i] for i in row])
                    positions[r, :cu[-1]] = np.arange(cu[-1]) - np.repeat(cu[:-1], sizes)
                    ends.append(cu.tolist())
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(base + made, base + made + len(out)), pa.int64()),
                    pa.array([e[-1] for e in ends], pa.int32()),
                    pa.array([[keys[i][0] for i in row] for row in out], pa.list_(arrow_id)),
                    pa.array([[keys[i][1] for i in row] for row in out], pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                    pa.array([x.tobytes() for x in positions], pa.binary()),
                ], names=["pack_id", "n_tokens", "doc_ids", "pieces", "cu_seqlens", "token_ids", "position_ids"])
                made += len(out)
            keys.clear()
            pieces.clear()
            held = 0

        for batch in batches:
            arrow_id = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                ids = encoded(encoder, text).astype(id_kind)
                for n, at in enumerate(range(0, len(ids), seq_len)):
                    keys.append((key, n))
                    pieces.append(ids[at:at + seq_len])
                held += len(ids)
                if held >= run_tokens:
                    yield from flush()
        if pieces:
            yield from flush()

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        pack, SCHEMA.format(id=id_type.simpleString()))


def unpacked(rows, vocabulary_path: str = VOCABULARY) -> dict:
    """Texts by document id of collected packed rows (for tests and spot checks)."""
    vocabulary = read_vocabulary(vocabulary_path)
    kind = "<u2" if len(vocabulary) < 65536 else "<u4"
    parts: dict = {}
    for row in rows:
        ids = np.frombuffer(row["token_ids"], kind)
        for doc, piece, a, b in zip(row["doc_ids"], row["pieces"], row["cu_seqlens"], row["cu_seqlens"][1:], strict=False):
            parts.setdefault(doc, {})[piece] = b"".join(vocabulary[i] for i in ids[a:b])
    return {doc: b"".join(p[k] for k in sorted(p)).decode() for doc, p in parts.items()}


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write the packed matrices as Parquet files of binary columns."""
    packed(docs, **options).write.option("compression", "zstd").parquet(path)


def op9_pack_token_ids(spark, sf_dir: str) -> DataFrame:
    """Packed rows of all documents."""
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
