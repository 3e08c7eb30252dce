"""Driver contract and plan-level properties of the registered queries."""

import pytest

from conftest import SF001, plan_text

import __spark_entry__ as entry

ML_KEYS = {"kmeans_sweep", "user_segments", "cluster_counts", "cluster_centroids",
           "segment_counts", "segment_profile", "segment_lookup"}
STREAM_KEYS = {k for k in entry.queries() if k.startswith("stream_")} | {"compact_fact"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "active_users", "avg_progress_pct", "avg_watch_duration"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 60


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - ML_KEYS - STREAM_KEYS))
def test_no_python_in_plans(spark, name):
    plan = plan_text(entry.queries()[name](spark, SF001), "simple")
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, f"{name} runs Python per row: {node}"


def test_reports_scan_only_needed_columns(spark):
    plan = plan_text(entry.queries()["top_devices"](spark, SF001), "formatted")
    scan = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert any("device_type" in s and "watch_duration_minutes" not in s for s in scan)


def test_dimensions_are_broadcast_by_size(spark):
    plan = plan_text(entry.queries()["peak_hours"](spark, SF001), "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name,key", [
    ("genre_popularity", "movie_id"), ("binge_genres", "movie_id"), ("ri_report", "movie_id"),
    ("gold_sales_daily", "order_id"), ("gold_category_performance", "product_id"),
])
def test_fact_is_combined_before_the_shuffle(spark, name, key):
    """A hot key collapses map-side: the fact is aggregated per join key
    (partial aggregate) before it is shuffled on that key."""
    plan = plan_text(entry.queries()[name](spark, SF001), "simple")
    lines = plan.splitlines()
    shuffles = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(" + key in l]
    assert shuffles, plan
    assert any("partial_" in lines[i + 1] for i in shuffles), plan


def test_dedup_is_an_aggregate_not_a_window(spark):
    plan = plan_text(entry.queries()["dim_users"](spark, SF001), "simple")
    assert "Window" not in plan and "partial_min" in plan


def test_compaction_rebalances(spark, tmp_path):
    from reelpulse.streaming import ingest as st
    from reelpulse.sources import io as rio
    from reelpulse import schemas

    df = spark.createDataFrame([(str(i), "u", "m", "TV", 1.0, 1.0, "a", "HD", 1, "VN", "2024010100") for i in range(4)],
                               schemas.WATCH_FACT)
    rio.append_fact(df, str(tmp_path / "f"), 0)
    plan = plan_text(rio.read_fact(spark, str(tmp_path / "f"), "watch").hint("rebalance", "date_key"), "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    st.compact(spark, str(tmp_path / "f"), str(tmp_path / "g"))
    assert rio.read_fact(spark, str(tmp_path / "g"), "watch").count() == 4


def test_hot_key_is_split_when_the_dimension_is_too_big_to_broadcast(spark):
    """Beyond the broadcast threshold the planner falls back to a sort-merge
    join, and AQE splits the partition of a key holding a third of the
    fact (here: the orphan anti-join)."""
    from pyspark.sql import functions as F

    from reelpulse.operators import quality as dq

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000 + 10000)
        fact = spark.range(300000).select(hot.alias("movie_id"), F.rand(1).alias("x"))
        dim = spark.range(5000).select(F.col("id").alias("movie_id"))
        out = dq.orphans(fact, dim, "movie_id", "movie_id").select("movie_id")
        assert len(out.collect()) == 200000
        assert "SortMergeJoin(skew=true)" in plan_text(out, "simple")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
