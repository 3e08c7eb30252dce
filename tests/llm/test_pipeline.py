import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from fixtures import plain, shingles  # noqa: E402

import corpus_pipeline  # noqa: E402
from reelpulse.llm import pu_quality  # noqa: E402
from reelpulse.llm.common import stored  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    from test_native_ops import brute_hits, brute_targets

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept, columns = {"": docs}, docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = stored(stage(spark, frames[-1], SF), "test_stage")
        frames.append(kept[name])
    assert all(f.columns == columns for f in frames[:-1])
    assert frames[-1].columns == [*columns, "virtual_slot", "shard"]
    scores = {r.doc_id: r.score for r in pu_quality.quality_scores(docs, labels).collect()}
    first = {r.doc_id: r for r in frames[1].collect()}
    assert set(first) == {i for i, s in scores.items() if s >= 0.5}
    # one document of each group
    sets = {i: shingles(r.text) for i, r in first.items()}
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    second = {r.doc_id for r in frames[2].collect()}
    assert second == {i for i in ids if root(i) == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    third = {r.doc_id for r in frames[3].collect()}
    assert third == {i for i in second if brute_hits(first[i].text, bench)[1] == 0}
    sizes = {}
    for i in third:
        sizes[first[i].source] = sizes.get(first[i].source, 0) + len(plain(first[i].text))
    target = brute_targets(sizes)
    copies = {i: 0 for i in third}
    for r in frames[4].collect():
        copies[r.doc_id] += 1
    for i, n in copies.items():
        each = target[first[i].source] / max(sizes[first[i].source], 1)
        assert int(each) <= n <= min(int(each) + 1, 3)
    load = np.zeros(8)
    for r in frames[5].collect():
        load[r.shard] += len((r.text or "").encode()) + 1
    assert frames[5].count() == sum(copies.values()) and load.max() < 2 * load.mean()
    assert corpus_pipeline.run(spark, SF).count() == frames[5].count()


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    from fixtures import corpus, documents

    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus(n=40) + [(None, "a text without id", None, None, None)]
    for table in (documents(spark, rows, extra=True), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            assert set(table.columns) <= set(out.columns)
            out.count()


def test_whole_texts_go_to_python_in_small_batches(spark, monkeypatch):
    from reelpulse.llm import jaccard_join
    from reelpulse.llm.common import TEXTS_AT_ONCE

    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    for module in (jaccard_join, pu_quality):
        def spy(df, name):
            seen.setdefault(name, set()).add(spark.conf.get(key))
            return stored(df, name)
        monkeypatch.setattr(module, "stored", spy)
    before = spark.conf.get(key)
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, None), (4, "other words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (4, 0)], "doc_id long, quality int")
    assert {r.doc_id for r in jaccard_join.one_per_group(docs).collect()} == {1, 3, 4}
    pu_quality.good_documents(docs, labels).count()
    for name in ("signatures", "prefixes", "sets", "quality_features", "good_documents"):
        assert seen[name] == {str(TEXTS_AT_ONCE)}, name
    assert spark.conf.get(key) == before


def test_rows_not_among_keys_are_told_apart_in_place(spark):
    from pyspark.sql import functions as F

    from reelpulse.llm.common import _with_hit, among, without

    rows = [(i, f"text {i}") for i in range(3000)] * 2 + [(None, "no id"), (None, None), (7, None), (7, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = [(i, f"text {i}") for i in range(0, 3000, 60)] * 2 + [(None, "no id"), (7, None), (9, "elsewhere")]
    keys = spark.createDataFrame(gone, "k long, t string")
    left = [(r.doc_id, r.text) for r in without(docs, keys, [F.col("doc_id"), F.col("text")]).collect()]
    assert sorted(left, key=str) == sorted((r for r in rows if r not in gone), key=str)
    # what the join gets: the keys' rows and hardly any other
    held = keys.distinct()
    hit = {(r.doc_id, r.text) for r in _with_hit(docs, [F.col("doc_id"), F.col("text")], held, 1).filter("_hit").collect()}
    assert set(gone) & set(rows) <= hit and len(hit) < len(set(gone)) + 300
    ids = spark.createDataFrame([(7,), (60,)], "rep long")
    found = sorted((r.doc_id, r.text or "") for r in among(docs, ids, "doc_id").collect())
    assert found == sorted((i, t or "") for i, t in rows if i in (7, 60))
    empty = spark.createDataFrame([], "k long, t string")
    assert without(docs, empty, [F.col("doc_id"), F.col("text")]).count() == len(rows)


def test_a_stored_table_leaves_no_shuffle_files(spark):
    import time

    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in (blocks.apply(i).toString() for i in range(blocks.size())) if "shuffle" in b}

    before = shuffled()
    stored(spark.range(20000).selectExpr("id % 97 AS k", "id").repartition(4, "k"), "test_shuffle")
    end = time.time() + 20
    while shuffled() - before and time.time() < end:  # removed in the background
        time.sleep(0.2)
    assert not shuffled() - before


def test_list_entries_are_shuffled_once(spark):
    from pyspark.sql import functions as F

    from reelpulse.llm.jaccard_join import _dealt

    raw = spark.range(4000).selectExpr("id div 2 AS shingle", "id AS rep", "id % 3 AS label")
    entries = _dealt(stored(raw, "test_entries"))
    lists = entries.groupBy("shingle").agg(F.min("label").alias("first"), F.max("label").alias("last"),
                                           F.min("rep").alias("pivot"))
    both = entries.hint("merge").join(lists.filter("first <> last"), "shingle").filter("label <> first")
    assert both.count() == 2 * 2000 - sum(1 for i in range(4000) if (i % 3) == min((i - i % 2) % 3, (i - i % 2 + 1) % 3))
    both.collect()
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()
