import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import corpus, documents, plain, shingles  # noqa: E402

from reelpulse.llm import backoff, balltree, jaccard_join, packing, pu_quality, token_count  # noqa: E402
from reelpulse.llm.components import components  # noqa: E402


# -- n-gram Jaccard join ----------------------------------------------------

def brute_components(rows):
    ids = [r[0] for r in rows if r[0] is not None]
    sets = {}
    for doc, text, *_ in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingles(text))
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= 75 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    rows = corpus(seed=seed) + [(None, "one two three four five six", None, None, None)]
    want = brute_components(rows)
    out = jaccard_join.near_duplicates(documents(spark, rows, extra=True)).collect()
    assert len(out) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in out:
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.n_shingles == (len(shingles(text[r.doc_id])) if r.doc_id is not None else 2)


def test_many_near_copies_and_a_common_passage(spark):
    rnd = random.Random(5)
    word = lambda: "w" + str(rnd.randrange(10**6))
    base, passage = [word() for _ in range(80)], [word() for _ in range(60)]
    rows = []
    for i in range(150):  # copies with one or two words changed: most pairs are over the threshold, not all
        words = list(base)
        for _ in range(rnd.randrange(1, 3)):
            words[rnd.randrange(len(words))] = word()
        rows.append((i, " ".join(words), None, None, None))
    for i in range(150, 220):  # a shared passage in texts that are otherwise different
        rows.append((i, " ".join([word() for _ in range(rnd.choice([8, 30, 100]))] + passage), None, None, None))
    want = brute_components(rows)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == want


def test_full_join_alone_finds_everything(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIVOT_ROUNDS", 1)
    monkeypatch.setattr(jaccard_join, "pivot_pairs",
                        lambda lists, seed, percent: lists.select(lists.rep.alias("a"), lists.rep.alias("b")).limit(0))
    rows = corpus(seed=3)
    want = brute_components(rows)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == want


@pytest.mark.parametrize("alone", [False, True])
def test_one_sided_copies_against_brute_force(spark, monkeypatch, alone):
    """Texts contained in others: cut short, or with words added at an end or
    inside, so that the differences are on one side."""
    if alone:  # without pivots: all pairs come from the full join
        monkeypatch.setattr(jaccard_join, "PIVOT_ROUNDS", 1)
        monkeypatch.setattr(jaccard_join, "pivot_pairs",
                            lambda lists, seed, percent: lists.select(lists.rep.alias("a"), lists.rep.alias("b")).limit(0))
    rnd, texts = random.Random(11), []
    word = lambda: "w" + str(rnd.randrange(10**6))
    for length in [10, 12, 15, 20, 30, 50, 80, 120, 200, 300] * 3:
        base = [word() for _ in range(length)]
        extra = [word() for _ in range(rnd.randrange(1, max(2, length // 4)))]
        at = rnd.randrange(length)
        forms = [base[:length - len(extra)], base + extra, extra + base, base[:at] + extra + base[at:]]
        copies = rnd.choice([1, 1, 1, 25])
        for words in [base, *rnd.sample(forms, rnd.choice([1, 2]))]:
            texts += [" ".join(words)] * (copies if words is base or rnd.random() < 0.3 else 1)
    rnd.shuffle(texts)
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    distinct = {t: i for i, t in reversed(list(enumerate(texts)))}
    first = brute_components([(i, t, None, None, None) for t, i in distinct.items()])
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: first[distinct[t]] for i, t in enumerate(texts)}


@pytest.mark.parametrize("alone", [False, True])
def test_ids_with_several_texts_are_one_node(spark, monkeypatch, alone):
    """Groups of four texts A, B, C, D: the middle id has B and C, so it links with
    the ids of copies of either, and joins their components."""
    if alone:
        monkeypatch.setattr(jaccard_join, "PIVOT_ROUNDS", 1)
        monkeypatch.setattr(jaccard_join, "pivot_pairs",
                            lambda lists, seed, percent: lists.select(lists.rep.alias("a"), lists.rep.alias("b")).limit(0))
    rnd, rows = random.Random(12), [(1, "x y", None, None, None), (2, "x y", None, None, None), (2, "p q", None, None, None),
                                    (3, "p q", None, None, None), (4, "r s", None, None, None), (3, "r s", None, None, None)]
    word = lambda: "w" + str(rnd.randrange(10**6))
    for g in range(10, 70, 3):
        a, b = ([word() for _ in range(rnd.choice([40, 90, 250]))] for _ in range(2))
        near = lambda w: " ".join([*w[:-2], word(), word()])
        rows += [(g, near(a), None, None, None), (g + 1, " ".join(a), None, None, None),
                 (g + 1, " ".join(b), None, None, None), (g + 2, near(b), None, None, None)]
    rnd.shuffle(rows)
    want = brute_components(rows)
    assert want[4] == 1 and want[12] == 10
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == want


def test_prefix_choice():
    flat = np.zeros(100)
    assert jaccard_join.choose_prefix(flat) == (1, 26)  # nothing to gain from a longer prefix
    hot = np.full(100, 5000.0)
    l, length = jaccard_join.choose_prefix(hot)
    assert l == jaccard_join.MAX_MATCH and length == 25 + l
    assert jaccard_join.choose_prefix(np.zeros(1)) == (1, 1)


def test_jaccard_empty_and_one_per_group(spark):
    assert jaccard_join.near_duplicates(documents(spark, [])).count() == 0
    rows = corpus()
    want = brute_components(rows)
    docs = documents(spark, rows, extra=True)
    kept = jaccard_join.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if want[r[0]] == r[0])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (5, 5)]
    out = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert out == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_of_random_graphs(spark, kind):
    rnd = random.Random(21)
    name = int if kind == "long" else "n{:03d}".format
    edges = [(name(rnd.randrange(300)), name(rnd.randrange(300))) for _ in range(170)] + [(name(7), name(i)) for i in range(0, 300, 9)]
    least = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    got = components(spark.createDataFrame(edges, f"a {kind}, b {kind}")).collect()
    assert len(got) == len(least) and {r.node: r.component for r in got} == least


def test_components_write_little(spark, monkeypatch):
    """Edges that are stars are written once; a round of others is one table more."""
    module, written = sys.modules[components.__module__], []
    keep = module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: written.append(name) or keep(df, name))
    stars = [(i, i % 3) for i in range(3, 60)]
    out = dict(map(tuple, components(spark.createDataFrame(stars, "a long, b long")).collect()))
    assert out == {i: i % 3 for i in range(60)} and len(written) == 1
    written.clear()
    two = [(i, i % 2) for i in range(2, 60)] + [(40, 61), (61, 41)]
    out = dict(map(tuple, components(spark.createDataFrame(two, "a long, b long")).collect()))
    assert set(out.values()) == {0} and len(written) <= 5


def test_frequency_table_is_no_job_per_partition(spark):
    rows = spark.createDataFrame(
        [(task, chunk, np.full(jaccard_join.CHUNK, 60000 + chunk, np.uint16).tobytes()) for task in range(70) for chunk in (0, 3)]
        + [(None, None, None)], "task int, chunk int, counts binary")
    bits = (4 * jaccard_join.CHUNK).bit_length() - 1
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    context = spark.sparkContext
    try:
        for n, value in zip(names, ("24", "false"), strict=True):
            spark.conf.set(n, value)
        context.setJobGroup("frequency_table", "")
        got = jaccard_join.frequency_table(rows, bits)
        jobs = context.statusTracker().getJobIdsForGroup("frequency_table")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for n, value in zip(names, before, strict=True):
            spark.conf.set(n, value)
    want = np.zeros(4 * jaccard_join.CHUNK, np.uint32)
    want[:jaccard_join.CHUNK], want[3 * jaccard_join.CHUNK:] = 70 * 60000, 70 * 60003
    assert (got == want).all() and len(jobs) < 10


# -- stupid backoff ---------------------------------------------------------

def brute_scores(texts, alpha=0.4, least=2):
    import math
    from collections import Counter

    docs = [plain(t) for t in texts]
    c = [Counter(tuple(d[i:i + n]) for d in docs for i in range(len(d) - n + 1)) for n in (1, 2, 3)]
    total = sum(map(len, docs))
    out = []
    for d in docs:
        score = backed = 0
        for i in range(len(d)):
            top = min(i, 2)
            for n in range(top, -1, -1):
                gram = tuple(d[i - n:i + 1])
                if n == 0 or c[n][gram] >= least:
                    below = c[n - 1][gram[:-1]] if n else total
                    score += math.log(c[n][gram] / below) + (top - n) * math.log(alpha)
                    backed += n < top
                    break
        out.append((len(d), score, backed))
    return out


def test_backoff_against_brute_force(spark):
    rows = corpus()
    want = {}
    for row, x in zip(rows, brute_scores([r[1] for r in rows]), strict=True):
        want[row[0]] = x
    for block_rows in (7, 10_000):
        out = backoff.lm_scores(documents(spark, rows, extra=True), block_rows=block_rows).collect()
        assert len(out) == len(rows)
        for r in out:
            n, score, backed = want[r.doc_id]
            assert (r.n_words, r.n_backoff) == (n, backed) and r.log_score == pytest.approx(score)
    assert backoff.lm_scores(documents(spark, [])).count() == 0


def test_backoff_buckets_follow_the_text(spark, monkeypatch):
    assert backoff.bucket_count(0, 8) == 16
    assert backoff.bucket_count(30 << 30, 8) * backoff.BUCKET_BYTES >= 30 << 30
    rows, made, count = corpus(), [], backoff.bucket_count
    monkeypatch.setattr(backoff, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(backoff, "bucket_count", lambda *a: made.append(count(*a)) or made[-1])
    want = {row[0]: x for row, x in zip(rows, brute_scores([r[1] for r in rows]), strict=True)}
    for r in backoff.lm_scores(documents(spark, rows), block_rows=30).collect():
        n, score, backed = want[r.doc_id]
        assert (r.n_words, r.n_backoff) == (n, backed) and r.log_score == pytest.approx(score)
    assert made == [-(-sum(len((r[1] or "").encode()) for r in rows) // 2000)] and made[0] > 16
    blank = documents(spark, [(None, None, None, None, None), (None, " ", None, None, None)])
    assert [tuple(r) for r in backoff.lm_scores(blank).collect()] == [(None, 0, 0.0, 0)] * 2


# -- token counts -----------------------------------------------------------

def brute_pieces(word, vocabulary):
    n = 0
    while word:
        for k in range(len(word), 0, -1):
            if word[:k] in vocabulary or k == 1:
                word, n = word[k:], n + 1
                break
    return n


def test_automaton_against_greedy_longest_match():
    rnd = random.Random(3)
    for _ in range(60):
        vocabulary = {bytes(rnd.choice(b"abc ") for _ in range(rnd.randrange(1, 7))) for _ in range(rnd.randrange(1, 40))}
        automaton = token_count.LongestMatch(sorted(vocabulary))
        words = [bytes(rnd.choice(b"abcd") for _ in range(rnd.choice([0, 1, 5, 30, 90]))) for _ in range(40)]
        want = [brute_pieces(w, vocabulary) for w in words]
        assert [automaton.count(w) for w in words] == want
        assert automaton.count_all(words).tolist() == want
    assert token_count.LongestMatch([]).count_all([b"abc", b""]).tolist() == [3, 0]


def test_token_counts_of_documents(spark):
    vocabulary = set(token_count.read_vocabulary())
    rows = corpus(n=40) + [(900, "x" * 20_000, None, None, None)]
    text = {r[0]: r[1] for r in rows}
    out = token_count.token_counts(documents(spark, rows, extra=True)).collect()
    assert len(out) == len(rows)
    for r in out:
        words = (text[r.doc_id] or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(brute_pieces(b" " + w, vocabulary) for w in words[:2000])
                                           if len(words) <= 2000 else r.n_tokens)
    assert token_count.token_counts(documents(spark, [])).count() == 0


# -- ball trees -------------------------------------------------------------

def test_topk_against_brute_force(spark):
    rnd = random.Random(9)
    same = [rnd.gauss(0, 1) for _ in range(8)]
    rows = [(i, same if i % 3 == 0 else [rnd.gauss(0, 1) + 2 * (i % 4) for _ in range(8)]) for i in range(900)]
    rows += [(1000, None), (1001, [1.0, None] * 4), (1002, [float("nan")] * 8), (1050, [float("inf")] * 8), (1003, []),
             (None, same), (7, rows[7][1]), (1004, [1.0, 2.0]), (1100, [0.5, -2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.selectExpr("*", "1 as score", "2 as shard", "3 as dim")
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {i: v for i, v in good if i % 50 == 0}.items():
        found = sorted(((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v)))[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    for shard_rows, query_rows in ((100, 4), (10_000, 500)):
        out = balltree.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, query_rows=query_rows)
        assert sorted(map(tuple, out.collect())) == sorted(want)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert balltree.top_k(none, F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_stay_exact():
    big = np.array([[2 ** 30, 1], [2 ** 30, 2], [-(2 ** 30), 5]], np.int64)
    tree = balltree.BallTree.build(np.array([1, 2, 3]), big)
    s, i = tree.search(np.array([9]), np.array([[2 ** 30, 1]], np.int64), 2,
                       np.array([balltree.NO_SCORE]), np.array([2 ** 63 - 1]))
    assert i.tolist() == [[2, 1]] and s.tolist() == [[2 ** 60 + 2, 2 ** 60 + 1]]


# -- quality ----------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = pu_quality.op7_pu_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    auc = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert auc > 0.95 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_quality_reads_no_held_out_label(spark):
    docs = documents(spark, corpus(n=200))

    labels = docs.select("doc_id", (F.length("text") % 3 != 0).cast("int").alias("quality"), F.lit(0).alias("toxic")).distinct()
    flipped = labels.withColumn("quality", F.when(pu_quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, pu_quality.quality_scores(docs, x).collect()), key=str) for x in (labels, flipped))
    assert a == b and all(0 <= s <= 1 for _, s in a)


def test_nonnegative_risk_and_edge_cases(spark):
    rnd = np.random.default_rng(0)
    web = np.concatenate([rnd.normal(2, 1, (700, 4)), rnd.normal(-2, 1, (300, 4))])
    model = pu_quality.PuModel(web)
    trace = model.fit(rnd.normal(2, 1, (400, 4)), web, 0.7)
    assert min(trace[-100:]) > -0.05  # the unseen risk is kept near or above zero
    s = model.score(web)
    assert (s[:700] >= 0.5).mean() > 0.95 and (s[700:] < 0.5).mean() > 0.9
    docs = documents(spark, corpus(n=20), extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in pu_quality.quality_scores(docs, none).collect()} == {0.5}
    assert pu_quality.good_documents(docs, none).count() == docs.count()
    assert pu_quality.quality_scores(documents(spark, []), none).count() == 0


def test_pu_risk_and_steps_against_plain_python():
    """The fit's risk trace and weights, recomputed sum by sum."""
    import math

    rnd = np.random.default_rng(4)
    n = len(pu_quality.FEATURES)
    good, web = rnd.normal(1, 1, (12, n)), np.concatenate([rnd.normal(1, 1, (10, n)), rnd.normal(-1, 1, (20, n))])
    prior, rate, decay, steps = 0.4, 0.03, 1e-3, 25
    model = pu_quality.PuModel(web)
    a, u = model.design(good).tolist(), model.design(web).tolist()
    trace = model.fit(good, web, prior, steps=steps, rate=rate, decay=decay)
    k = len(a[0])
    w, m, v = [0.0] * k, [0.0] * k, [0.0] * k
    w[-1] = math.log(prior / (1 - prior))
    sigmoid = lambda x: 1 / (1 + math.exp(-sum(p * q for p, q in zip(x, w, strict=True))))
    for t in range(1, steps + 1):
        sa, su = [sigmoid(x) for x in a], [sigmoid(x) for x in u]
        # unlabelled side of the unbiased risk: E_u[l(-g)] - prior * E_p[l(-g)]
        loss = lambda s: -math.log(max(1 - s, 1e-12))
        risk = sum(map(loss, su)) / len(u) - prior * sum(map(loss, sa)) / len(a)
        assert trace[t - 1] == pytest.approx(risk, rel=1e-7)
        for j in range(k):
            positive = prior * sum((s - 1) * x[j] for s, x in zip(sa, a, strict=True)) / len(a)
            negative = (sum(s * x[j] for s, x in zip(su, u, strict=True)) / len(u)
                        - prior * sum(s * x[j] for s, x in zip(sa, a, strict=True)) / len(a))
            step = (positive + negative if risk >= 0 else -negative) + (decay * w[j] if j < k - 1 else 0)
            m[j], v[j] = 0.9 * m[j] + 0.1 * step, 0.999 * v[j] + 0.001 * step * step
        w = [w[j] - rate * (m[j] / (1 - 0.9 ** t)) / (math.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8) for j in range(k)]
    assert model.weights.tolist() == pytest.approx(w, rel=1e-6, abs=1e-9)


# -- packing ----------------------------------------------------------------

def test_long_runs_keep_the_tokenizers_ids(spark):
    """Unbroken runs of many short pattern matches, and matches around a long
    one, have the ids of the text encoded at once."""
    rnd = random.Random(3)
    encoder = packing.make_encoder(packing.read_vocabulary(packing.VOCABULARY))
    mixed = "".join(rnd.choice("ab1Z/+=.'sé") + rnd.choice("q7-_s") for _ in range(3000))
    assert packing.bounded_parts(mixed) == [mixed]
    want = {0: mixed, 1: "see https://x.org/" + mixed + " end", 2: "short"}
    out = packing.packed(documents(spark, [(i, t, None, None, None) for i, t in want.items()])).collect()
    ids = {}
    for row in out:
        tokens = np.frombuffer(row.token_ids, "<u2")
        for doc, piece, a, b in zip(row.doc_ids, row.pieces, row.cu_seqlens, row.cu_seqlens[1:], strict=False):
            ids.setdefault(doc, {})[piece] = tokens[a:b].tolist()
    for i, text in want.items():
        assert sum((ids[i][k] for k in sorted(ids[i])), []) == encoder.encode_ordinary(text)

    # one long match has the ids of the text encoded at once, too
    for text in ("a" * 2500, "7" * 70_001, "x" + " " * 30_000 + "y", "'" * 2001, "\u3042" * 3000):
        assert packing.encoded(encoder, text).tolist() == encoder.encode_ordinary(text)
    refused = "\n " * 600_000 + "end"
    pieces = packing.read_vocabulary(packing.VOCABULARY)
    assert b"".join(pieces[i] for i in packing.encoded(encoder, refused)) == refused.encode()

    split = packing.PATTERN.findall
    for long in ("a" * 2500, " " + "b" * 1000, "7" * 1001, "'" * 2001, " " * 2500, "\n" * 1002, "\u3042" * 3000):
        for before in ("", "x", "it's", "x \n", "\n\n", "  ", "\t\t ", "x\n "):
            for after in ("", "s", "'s", " s", "\n\ny", "1", "  z"):
                text = before + long + after
                parts = packing.bounded_parts(text)
                assert "".join(parts) == text
                cut = [m for p in parts for m in split(p)]
                assert max(map(len, cut)) <= packing.MAX_UNBROKEN
                broken = [m[i:i + packing.MAX_UNBROKEN] for m in split(text)
                          for i in range(0, len(m), packing.MAX_UNBROKEN)]
                assert cut == broken


def test_packing_round_trip(spark):
    rows = corpus(n=60) + [(900, "y" * 30_000 + " \n" * 3000, None, None, None), (901, "naïve \U0001F600 text", None, None, None)]
    docs = documents(spark, rows, extra=True)
    out = packing.packed(docs, seq_len=256, run_tokens=5000).collect()
    texts = packing.unpacked(out)
    want = {r[0]: r[1] for r in rows if r[1]}
    assert texts == want
    assert len({r.pack_id for r in out}) == len(out)
    for r in out:
        ids, positions = np.frombuffer(r.token_ids, "<u2"), np.frombuffer(r.position_ids, "<u4")
        cu = r.cu_seqlens
        assert len(ids) == len(positions) == 256 and cu[0] == 0 and cu[-1] == r.n_tokens <= 256
        for a, b in zip(cu, cu[1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a)) and b > a
        assert (ids[cu[-1]:] == 50256).all() and not positions[cu[-1]:].any()
    assert packing.packed(documents(spark, [])).count() == 0


def test_best_fit_decreasing():
    rnd = random.Random(2)
    for _ in range(50):
        lengths = [rnd.randrange(1, 65) for _ in range(rnd.randrange(1, 80))]
        rows = packing.best_fit(lengths, 64)
        assert sorted(i for row in rows for i in row) == list(range(len(lengths)))
        room, want = [], 0  # the same rule with a plain list
        for n in sorted(lengths, reverse=True):
            fits = [r for r in room if r >= n]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - n)
            else:
                want += 1
                room.append(64 - n)
        assert len(rows) == want and all(sum(lengths[i] for i in row) <= 64 for row in rows)
