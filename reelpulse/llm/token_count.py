"""Token counts by a linear longest-match automaton.

A text's words are cut greedily into the longest vocabulary pieces (a word's
first piece starts with the blank before the word).  Only the number of pieces
is wanted, so no piece is ever built: the vocabulary is a trie whose nodes carry
a failure link (the node of what is left after the pieces that are certain have
been popped) and the number of pieces popped on that way.  A word is read byte
by byte; where the trie has no child, the popped count is added and the link is
followed.  Each byte is read once, links only move towards the root.

Words repeat, so a batch's new words run through the automaton together, column
by column in numpy, and a bounded word memo serves the rest; very long words are
walked one by one with the same tables.

Defined results: null text has 0 words and 0 tokens; every input row gets one
row; a byte that the vocabulary lacks counts as one token.
"""

from __future__ import annotations

import base64
import os
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelpulse.llm.ngrams import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary travels to every worker, so its size is checked.
MAX_VOCABULARY_BYTES = 64 * 1024 * 1024
#: Words memoised per worker, and the longest word of a column-wise batch.
MEMO_WORDS = 500_000
COLUMN_BYTES = 48


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a rank file: one base64 piece and its rank per line."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class LongestMatch:
    """Trie with failure links and popped-piece counts, as flat arrays.

    Edges are sorted by ``node * 256 + byte``; node 0 is the root.
    """

    def __init__(self, vocabulary: list[bytes]):
        edges: dict[int, int] = {}
        piece_ends, n = set(), 1
        for piece in vocabulary:
            node = 0
            for byte in piece:
                key = node * 256 + byte
                child = edges.get(key)
                if child is None:
                    child = edges[key] = n
                    n += 1
                node = child
            if node:
                piece_ends.add(node)
        self.fail = np.zeros(n, np.int64)
        self.pops = np.zeros(n, np.int64)
        children: dict[int, list] = {}
        for key, child in edges.items():
            children.setdefault(key // 256, []).append((key % 256, child))
        todo = deque([0])
        while todo:
            node = todo.popleft()
            for byte, child in children.get(node, ()):
                todo.append(child)
                if child in piece_ends:  # the whole string is a piece: pop it, nothing is left
                    self.pops[child] = 1
                    continue
                left, popped = (int(self.fail[node]), int(self.pops[node])) if node else (0, 0)
                while left and left * 256 + byte not in edges:
                    popped += int(self.pops[left])
                    left = int(self.fail[left])
                step = edges.get(left * 256 + byte) if node else None
                if step is None:  # not even the byte alone is a piece
                    self.fail[child], self.pops[child] = 0, popped + 1
                else:
                    self.fail[child], self.pops[child] = step, popped
        order = sorted(edges)
        self.keys = np.array(order + [-1], np.int64)[:-1] if order else np.zeros(0, np.int64)
        self.child = np.array([edges[k] for k in order], np.int64)
        self._edges = None

    def __getstate__(self):
        return {**self.__dict__, "_edges": None}

    def count(self, word: bytes) -> int:
        """Pieces of one word, byte by byte."""
        if self._edges is None:
            self._edges = dict(zip(self.keys.tolist(), self.child.tolist(), strict=True))
        edges, fail, pops = self._edges, self.fail, self.pops
        node = total = 0
        for byte in word:
            step = edges.get(node * 256 + byte)
            while step is None and node:
                total += int(pops[node])
                node = int(fail[node])
                step = edges.get(node * 256 + byte)
            if step is None:
                total += 1
            else:
                node = step
        while node:
            total += int(pops[node])
            node = int(fail[node])
        return total

    def count_all(self, words: list[bytes]) -> np.ndarray:
        """Pieces of many words at once; the words advance column by column."""
        totals = np.zeros(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(lengths > COLUMN_BYTES):
            totals[i] = self.count(words[i])
        short = np.flatnonzero(lengths <= COLUMN_BYTES)
        if not len(short) or not len(self.keys):
            totals[short] = lengths[short]
            return totals
        short = short[np.argsort(-lengths[short], kind="stable")]
        sizes = lengths[short]
        width = int(sizes[0])
        flat = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in short), np.uint8)
        columns = flat.reshape(len(short), width).T.astype(np.int64) if width else []
        node, total = np.zeros(len(short), np.int64), np.zeros(len(short), np.int64)
        for j in range(width):
            todo = np.arange(np.searchsorted(-sizes, -j, side="left"))  # words longer than j come first
            while len(todo):
                key = node[todo] * 256 + columns[j][todo]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = self.keys[at] == key
                node[todo[found]] = self.child[at[found]]
                todo = todo[~found]
                lost = node[todo] == 0
                total[todo[lost]] += 1
                todo = todo[~lost]
                total[todo] += self.pops[node[todo]]
                node[todo] = self.fail[node[todo]]
        while node.any():
            total += self.pops[node] * (node > 0)
            node = self.fail[node]
        totals[short] = total
        return totals


def token_counts(docs: DataFrame, vocabulary: list[bytes] | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_tokens."""
    automaton = LongestMatch(read_vocabulary() if vocabulary is None else vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        memo: dict[bytes, int] = {}
        for batch in batches:
            texts, n_words, n_tokens = batch.column(1).to_pylist(), [], []
            for i, j in slices(texts):
                split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts[i:j]]
                seen = {w for words in split for w in words}
                fresh = list(seen.difference(memo))
                if len(memo) + len(fresh) > MEMO_WORDS:
                    memo.clear()
                    fresh = list(seen)
                memo.update(zip(fresh, automaton.count_all([b" " + w for w in fresh]).tolist(), strict=True))
                n_words += map(len, split)
                n_tokens += [sum(map(memo.__getitem__, words)) for words in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        count, f"doc_id {id_type}, n_words long, n_tokens long")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Greedy piece counts of every document."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
