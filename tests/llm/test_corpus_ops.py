"""Phrase mining, first-fit packing and the Merkle manifest against plain rules."""

import hashlib
import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import CLASHES, documents  # noqa: E402

from reelpulse.llm import double_array, ffd_packing, merkle, phrases  # noqa: E402


# -- phrases ----------------------------------------------------------------

def brute_phrases(rows, min_count, top, cover, max_words=4):
    counts, totals = {}, Counter()
    for _, text, lang, _, _ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(c, "\n")
        for piece in low.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            totals[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items()):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def phrase_rows(seed=3):
    rnd = random.Random(seed)
    words = ["New", "york", "City", "été", "a", "the", "of", "x\x00y", "Ünï", "日本"]
    rows = []
    for i in range(900):
        text = "".join(rnd.choice(words) + rnd.choice([" "] * 8 + ["  ", ", ", "\t", ".\n", "\r", "\x0b", "! "]) for _ in range(rnd.choice([1, 6, 60])))
        rows.append((i, text, ["en", "de", "", None, "und"][i % 5], "s", 1))
    return rows + [rows[5]] * 40 + [(900, None, "en", None, None), (901, "", None, None, None), (None, " , . ", "fr", "a", 0),
                                   (902, "new york " * 3000, "en", "a", 0)]


def phrase_result(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_phrases_match_brute_force(spark, monkeypatch):
    rows = phrase_rows()
    docs = documents(spark, rows, extra=True).repartition(3)
    expected = brute_phrases(rows, 30, 12, 80)
    assert {r[0] for r in expected} == {"", "de", "en", "und"}
    assert phrase_result(phrases.collocations(docs, top=12, filter_bits=20)) == expected
    # many small tries, a filter that lets most words through, and blocks that are
    # read in small steps give the same
    monkeypatch.setattr(phrases, "STEP", 17)
    assert phrase_result(phrases.collocations(docs, top=12, trie_phrases=40, filter_bits=4)) == expected


def test_phrases_take_no_more_passes_for_more_tries(spark, monkeypatch):
    real, steps = phrases.stored, []
    monkeypatch.setattr(phrases, "stored", lambda df, name: steps.append(name) or real(df, name))
    docs = documents(spark, phrase_rows()[:200], extra=True).repartition(2)
    results = []
    for trie_phrases in (150_000, 20):
        steps.append("start")
        results.append(phrase_result(phrases.collocations(docs, min_count=5, filter_bits=16, trie_phrases=trie_phrases)))
    again = steps.index("start", 1)
    assert results[0] == results[1] != []
    assert steps[:again] == steps[again:]


def test_phrases_of_slices_too_large_to_hold(spark, monkeypatch):
    # trees of a few runs, of which a task holds a few: they go on in parts, with all runs
    rows = phrase_rows()
    monkeypatch.setattr(phrases, "FOLD", 300)
    monkeypatch.setattr(phrases, "HELD", 60)
    monkeypatch.setattr(phrases, "STEP", 500)
    docs = documents(spark, rows, extra=True).repartition(3)
    assert phrase_result(phrases.collocations(docs, top=12, filter_bits=20)) == brute_phrases(rows, 30, 12, 80)


def test_prefix_trees_keep_every_run():
    rnd = np.random.default_rng(5)
    # the same upper bits in all words, so that sorting by a part of them is not enough
    runs = rnd.integers(1, 9, (4, 3000)) + (1 << 40)
    length = rnd.integers(2, 5, 3000)
    runs[np.arange(4)[:, None] >= length] = 0
    expected = Counter(tuple(r[:k]) for r, n in zip(runs.T.tolist(), length.tolist(), strict=True) for k in range(2, n + 1))

    def counts(trees):
        out = Counter()
        for nodes in trees:
            names = list(zip(nodes[0].tolist(), nodes[1].tolist(), strict=True))
            for k in range(0, len(nodes), 3):
                if k:
                    names = [names[a] + (w,) for a, w in zip(nodes[k].tolist(), nodes[k + 1].tolist(), strict=True)]
                for name, n in zip(names, nodes[k + 2].tolist(), strict=True):
                    out[name] += n
        return out

    trees = [t for part in (runs[:, ::2], runs[:, 1::2]) for _, t in phrases.prefix_trees(part, 7)]
    one = phrases.joined_trees(trees)
    assert counts(trees) == counts([one]) == counts([phrases.merged(one)]) == expected
    assert sum(map(len, phrases.merged(one)[2::3])) == len(expected)
    assert counts([phrases.merged(one, 12)]) == {r: n for r, n in expected.items() if n >= 12}


def test_phrases_of_little_or_nothing(spark):
    for rows in ([], [(1, None, None, None, None)], [(1, "a b c", "en", "s", 5)], [(1, "word. " * 50, "en", "s", 5)]):
        assert phrase_result(phrases.collocations(documents(spark, rows), filter_bits=16)) == []


def test_phrases_survive_equal_hashes(spark, monkeypatch):
    real = phrases.word_ids
    monkeypatch.setattr(phrases, "word_ids", lambda w, lang, seed: real(w, lang, seed) if seed else real(w, lang, seed) & 3)
    rows = phrase_rows()[:60]
    assert phrase_result(phrases.collocations(documents(spark, rows), min_count=5, filter_bits=16)) == brute_phrases(rows, 5, 2000, 80)


def test_long_texts_and_blocks_keep_runs(monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 7)
    block = phrases.Block()
    block.add("one two three, four five " * 20)
    back = list(block.code_of)
    read = b" ".join(back[c] for c in np.concatenate(block.codes))
    assert read == (b"one two three , four five " * 20).strip() + b" ,"


def test_scores_past_64_bits(spark):
    big = 2 ** 55
    made = spark.createDataFrame([(1, [10, 11], "en", "x y", big), (2, [10, 11, 12], "en", "x y z", big // 2)],
                                 "id long, ids array<long>, lang string, phrase string, a long")
    words = spark.createDataFrame([(i, "en", w, big + i) for i, w in ((10, "x"), (11, "y"), (12, "z"))], "id long, lang string, word string, n long")
    got = {r.phrase: r.score for r in phrases.scored(made, words, 80).collect()}
    assert got["x y"] == 2000000 * big // (2 * big + 21)


@pytest.mark.parametrize("vocabulary,n", [(3, 20), (40, 900), (3000, 20000)])
def test_double_array_counts(vocabulary, n):
    rnd = np.random.default_rng(vocabulary)
    rows = np.minimum(rnd.zipf(1.3, (n, 4)), vocabulary) * 1009 - 5
    rows[rnd.integers(2, 5, n)[:, None] <= np.arange(4)] = -1
    rows = np.unique(rows, axis=0)
    trie, order = double_array.build(rows)
    text = np.minimum(rnd.zipf(1.3, 20000), vocabulary) * 1009 - 5
    text[rnd.random(len(text)) < .1] = 7
    got = np.zeros(len(rows), np.int64)
    for _, state in trie.walk(trie.symbol_of(text), 4):
        found = trie.accepted(state)
        got += np.bincount(found[found >= 0], minlength=len(rows))
    runs = Counter(tuple(text[i:i + k].tolist()) for k in (2, 3, 4) for i in range(len(text) - k + 1))
    assert got.tolist() == [runs[tuple(x for x in r if x != -1)] for r in rows[order].tolist()]


# -- packing ----------------------------------------------------------------

def packing_rows():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab éñ漢😀 \n\t.,!019'sA") for _ in range(rnd.choice([0, 3, 50, 700, 4000]))) for _ in range(60)]
    texts += [None, "", "it's   fine\n\n\n", "x" * 5000, " " * 3000 + "y", "a<|endoftext|>b", "\x00\x1c\x85 　b", "​﻿", "1" * 2000,
              "word " * 9000, "".join(chr(rnd.randrange(33, 0x2FFF)) for _ in range(6000))]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return rows + [rows[3]] * 25 + [(None, "no id", None, None, None)]


def test_packed_ids_are_the_tokenizers_own(spark):
    from tokenizers import Tokenizer

    rows = packing_rows()
    tokenizer = Tokenizer.from_file(ffd_packing.TOKENIZER)
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for i, t, *_ in rows:
        expected[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])] += 1
    pieces = ffd_packing.packed_pieces(documents(spark, rows, extra=True).repartition(3), group_bytes=20000).collect()
    docs, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert p.length == len(ids) > 0
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length, p.sequence_length))
        docs.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
    # documents with equal ids and sizes are copies here, so their pieces' ids agree place by place
    found = Counter()
    for (doc, total), parts in docs.items():
        copies = sum(len(x) for _, x in parts) // total
        whole = [None] * total
        for start, ids in parts:
            for k, x in enumerate(ids):
                assert whole[start + k] in (None, x)
                whole[start + k] = x
        found[doc, tuple(whole)] += copies
    assert found == expected
    for parts in by_sequence.values():
        at = 0
        for offset, length, whole in sorted(parts):
            assert offset == at
            at += length
        assert at == whole == parts[0][2] and (at == 1024 or at < 1024 and at & (at - 1) == 0)
    assert len(by_sequence) < sum(p.length for p in pieces) / 1024 + 11 * 60


def test_first_fit_is_first_fit():
    rnd = random.Random(5)
    for capacity in (1, 7, 64, 1024):
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.choice([1, 2, 300]))]
        room, expected = [], []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if at == len(room):
                room.append(capacity)
                expected.append([])
            room[at] -= lengths[i]
            expected[at].append(i)
        assert ffd_packing.first_fit_decreasing(lengths, capacity) == expected
        parts = [p for b in ffd_packing.closed(expected, lengths, capacity) for p in b]
        for i, n in enumerate(lengths):
            own = sorted((at, size) for piece, at, size in parts if piece == i)
            assert own[0][0] == 0 and all(a + s == b for (a, s), (b, _) in zip(own, own[1:], strict=False)) and sum(own[-1]) == n


def test_sequences_and_empty(spark, tmp_path):
    docs = documents(spark, packing_rows()[:30])
    ffd_packing.write_sequences(docs, str(tmp_path / "s"), seq_len=256)
    rows = spark.read.parquet(str(tmp_path / "s")).collect()
    assert all(len(r.ids) == 4 * r.n_tokens and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == len(r.doc_ids) + 1 for r in rows)
    assert ffd_packing.packed_pieces(documents(spark, [])).count() == 0
    assert [(p.doc_id, p.length) for p in ffd_packing.packed_pieces(documents(spark, [(1, None, None, None, None)])).collect()] == [(1, 1)]


# -- Merkle manifest --------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))

    def levels(row):
        out = [row]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def steps(tree, at):
        for row in tree[:-1]:
            run = row[at // 2 * 2:at // 2 * 2 + 2]
            yield run, at % 2
            at //= 2

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    for lang in trees:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    local = {lang: levels([leaf(r) for r in trees[lang]]) for lang in langs}
    top = levels([local[lang][-1][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for at, r in enumerate(trees[lang]):
            shown = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                shown[4] += 1
            node, proof = leaf(shown), ""
            for run, side in [*steps(local[lang], at), *steps(top, n)]:
                proof += "".join(x for k, x in enumerate(run) if k != side)
                node = sha("".join(node if k == side else x for k, x in enumerate(run)))
            out.append((r[0], lang, leaf(r), local[lang][-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(n=140):
    rnd = random.Random(6)
    rows = [(i * 3 - 50, rnd.choice([None, "", "téxt " * i, "x"]), rnd.choice(["en"] * 9 + ["de", None, "", "é", "z"]),
             rnd.choice([None, "", "a"]), rnd.choice([None, 0, i, 2 ** 63 - 1])) for i in range(n)]
    return rows + [rows[7]] * 3 + [(None, "t", "en", None, 1), (None, None, None, None, None), (5000, "only", "fr", "s", 4)]


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_matches_brute_force(spark, levels):
    rows = manifest_rows(60 if levels == 1 else 140)
    docs = documents(spark, rows, extra=True).repartition(4)
    got = merkle.manifest(docs, merkle.tampered_digest(), levels=levels)
    cols = ["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == brute_manifest(rows)


def test_manifest_small_and_empty(spark):
    assert merkle.manifest(documents(spark, [])).count() == 0
    one = merkle.manifest(documents(spark, [(1, "a", "en", None, 1)])).collect()[0]
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and one.proof_sha256 == sha("")
    assert CLASHES  # the awkward names are part of the tables above
