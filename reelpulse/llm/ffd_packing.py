"""First-fit decreasing packing of token ids in randomised groups of documents.

Every document's ids (with an end id) are cut into pieces of ``seq_len`` and a
shorter rest.  Rows are dealt to groups at random, a group for every
``GROUP_BYTES`` of text, so a group is of one size whatever the input; the full
pieces of a long text are dealt over further groups.  Each group packs alone:
pieces in decreasing order go to the first sequence with room, which a tournament
tree finds (every inner node holds the larger of its children's capacities, so the
leftmost bin that fits is one walk down).  What first fit leaves open is closed by
cutting: the emptiest sequences' pieces fill the gaps of the fullest ones, and the
one sequence that stays open is cut into lengths that are powers of two.  So no
sequence needs padding.

Ids are those of the tokenizer file: its merges run in an encoder for byte-level
BPE, which tests hold against the ``tokenizers`` library, text by text; a text that
this encoder refuses (its pattern engine gives up on hundreds of thousands of blanks in
a row) goes to that library itself.  Strings of special tokens are ordinary text.

Defined results: null and empty texts are the end id alone; repeated rows are
packed each; every id lies in one piece; an empty table gives no rows; other
columns are neither read nor returned.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpulse.llm.common import table
from reelpulse.llm.packing import make_encoder
from reelpulse.llm.token_count import MAX_VOCABULARY_BYTES

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SEQ_LEN = 1024
END_ID = 0
#: Text of a group, in bytes, and tokens of a result batch.
GROUP_BYTES = 8 * 1024 * 1024
BATCH_TOKENS = 1_000_000
SEED = 12
CUT = "grp long, doc_id {id}, start long, doc_tokens long, ids binary"
PIECE = ("doc_id {id}, start long, length long, doc_tokens long, sequence_id long, sequence_length int, "
         "offset long, ids binary")


def read_file(path: str = TOKENIZER) -> str:
    """A tokenizer file, which travels to every worker; its size is checked."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        return file.read()


def read_bpe(text: str, path: str = TOKENIZER) -> list[bytes]:
    """Pieces by id of a byte-level BPE tokenizer file whose ids follow its merges."""
    spec = json.loads(text)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or spec["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"]
            or not split["use_regex"] or model.get("ignore_merges")):
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    # A byte that prints stands for itself, the others for the code points from 256 on.
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printed)]
    byte_of = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(other)}
    ids = model["vocab"]
    for n, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        if ids[a + b] != 256 + n:
            raise ValueError(f"{path}: ids do not follow the merges")
    pieces = sorted(ids, key=ids.get)
    return [bytes(byte_of[c] for c in p) for p in pieces]


def encode_with(encoder, tokenizer_file: str):
    """text -> ids, by ``encoder`` or, where it gives up, by the tokenizer itself."""
    slow: list = []

    def encode(text: str) -> np.ndarray:
        try:
            return encoder.encode_to_numpy(text)
        except ValueError:
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_str(tokenizer_file))
                slow[0].encode_special_tokens = True
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, "<u4")
    return encode


class Tournament:
    """Capacities of bins in a row; the root holds the largest."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1
        while self.leaves < bins:
            self.leaves *= 2
        self.best = [capacity] * (2 * self.leaves)

    def first_fit(self, need: int) -> int:
        """The first bin with room, which then has ``need`` less."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < need:
                node += 1
        found = node - self.leaves
        best[node] -= need
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
        return found


def first_fit_decreasing(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Bins of piece indexes."""
    tree = Tournament(len(lengths), seq_len)
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = tree.first_fit(lengths[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def closed(bins: list[list[int]], lengths: list[int], seq_len: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (piece, from, length) without gaps; short bins have a power of two."""
    parts = [[(i, 0, lengths[i]) for i in b] for b in bins]
    load = [sum(p[2] for p in b) for b in parts]
    open_ = sorted((k for k in range(len(parts)) if load[k] < seq_len), key=lambda k: (-load[k], k))
    take, give = 0, len(open_) - 1
    while take < give:
        to, of = open_[take], open_[give]
        piece, at, n = parts[of].pop()
        fits = min(n, seq_len - load[to])
        parts[to].append((piece, at, fits))
        if fits < n:
            parts[of].append((piece, at + fits, n - fits))
        load[to] += fits
        load[of] -= fits
        take += load[to] == seq_len
        give -= load[of] == 0
    last = open_[take] if open_ and load[open_[take]] < seq_len else None
    out = [b for k, b in enumerate(parts) if b and k != last]
    rest = list(reversed(parts[last])) if last is not None else []
    total = sum(p[2] for p in rest)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        row = []
        while room:
            piece, at, n = rest.pop()
            fits = min(n, room)
            row.append((piece, at, fits))
            if fits < n:
                rest.append((piece, at + fits, n - fits))
            room -= fits
        out.append(row)
    return out


def packed_pieces(docs: DataFrame, tokenizer_path: str = TOKENIZER, seq_len: int = SEQ_LEN, end_id: int = END_ID,
                  group_bytes: int = GROUP_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start and length in its document, doc_tokens,
    sequence_id, sequence_length, offset in the sequence, and ids (little-endian,
    four bytes each)."""
    tokenizer_file = read_file(tokenizer_path)
    pieces_by_id = read_bpe(tokenizer_file, tokenizer_path)
    narrow = "<u2" if max(len(pieces_by_id) - 1, end_id) < 65536 else "<u4"
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    # Rows are dealt by their place in the input: copies of a row go to different groups.
    grp = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(SEED)), F.lit(groups))

    def cut(batches):
        encode = encode_with(make_encoder(pieces_by_id), tokenizer_file)
        for batch in batches:
            made: list[tuple] = []
            held = 0
            keys = batch.column(1)
            for r, (g, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2), strict=True)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype(narrow)
                for n, at in enumerate(range(0, len(ids), seq_len)):
                    piece = ids[at:at + seq_len]
                    to = (g + 1 + n) % groups if len(piece) == seq_len else g
                    made.append((to, r, at, len(ids), piece.tobytes()))
                held += len(ids)
                if held >= BATCH_TOKENS:
                    yield cut_batch(made, keys)
                    made, held = [], 0
            if made:
                yield cut_batch(made, keys)

    def cut_batch(made, keys):
        to, r, at, total, ids = zip(*made, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(to, pa.int64()), keys.take(pa.array(r, pa.int64())), pa.array(at, pa.int64()),
             pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
            names=["grp", "doc_id", "start", "doc_tokens", "ids"])

    def pack(part: pa.Table) -> pa.Table:
        first = part.column("grp")[0].as_py() << 32
        pieces = [np.frombuffer(x.as_buffer(), narrow) for x in part.column("ids")]
        lengths = [len(p) for p in pieces]
        made = []
        for s, row in enumerate(closed(first_fit_decreasing(lengths, seq_len), lengths, seq_len)):
            whole, offset = sum(p[2] for p in row), 0
            for piece, at, n in row:
                made.append((piece, at, n, first + s, whole, offset, pieces[piece][at:at + n].astype("<u4").tobytes()))
                offset += n
        piece, at, n, sequence, whole, offset, ids = zip(*made, strict=True)
        rows = pa.array(piece, pa.int64())
        start = part.column("start").combine_chunks().take(rows).to_numpy() + np.array(at, "i8")
        return pa.table({
            "doc_id": part.column("doc_id").combine_chunks().take(rows), "start": pa.array(start, pa.int64()),
            "length": pa.array(n, pa.int64()), "doc_tokens": part.column("doc_tokens").combine_chunks().take(rows),
            "sequence_id": pa.array(sequence, pa.int64()), "sequence_length": pa.array(whole, pa.int32()),
            "offset": pa.array(offset, pa.int64()), "ids": pa.array(ids, pa.binary())})

    return (rows.select(grp.alias("grp"), "doc_id", "text").mapInArrow(cut, CUT.format(id=id_type))
            .groupBy("grp").applyInArrow(pack, PIECE.format(id=id_type)))


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, doc_ids, starts and cu_seqlens
    (one entry per piece, cumulative from 0), and ids of all pieces in order."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    return pieces.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id",
        F.aggregate("inside", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.col("inside.doc_id").alias("doc_ids"), F.col("inside.start").alias("starts"),
        F.concat(F.col("inside.offset"), F.array(F.element_at("inside", -1)["offset"] + F.element_at("inside", -1)["length"]))
        .alias("cu_seqlens"),
        F.aggregate("inside", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"))


def write_sequences(docs: DataFrame, path: str, **options) -> None:
    """Write the sequences of ``docs`` as Parquet files of binary id rows."""
    sequences(packed_pieces(docs, **options)).write.option("compression", "zstd").parquet(path)


def op12_ffd_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    pieces = packed_pieces(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "sequence_length")
