import pytest
from pyspark.sql import functions as F

from reelpulse.operators import segment as sg
from reelpulse.operators import serving as sv
from reelpulse.schemas import FEATURE_COLUMNS

from conftest import SF001, rows


def test_merge_batch_speed(spark):
    batch = spark.createDataFrame([("Drama", 10), ("Comedy", 3), (None, 4)], "genre_primary string, watch_count long")
    speed = spark.createDataFrame([("Drama", 2), ("Horror", 1), (None, 9)], "genre_primary string, count long")
    assert rows(sv.merge_batch_speed(batch, speed, "genre_primary", "watch_count")) == [
        ("Comedy", 3), ("Drama", 12), ("Horror", 1)]
    empty = speed.limit(0)
    assert rows(sv.merge_batch_speed(batch, empty, "genre_primary", "watch_count")) == [("Comedy", 3), ("Drama", 10)]


def test_load_report_missing_is_empty_with_schema(spark, tmp_path):
    from reelpulse.sources.io import load_report, publish_report

    schema = "genre_primary string, count long"
    missing = load_report(spark, str(tmp_path / "nope"), spark.createDataFrame([], schema).schema)
    assert missing.count() == 0 and missing.columns == ["genre_primary", "count"]
    publish_report(spark.createDataFrame([("a", 1)], schema).withColumn("_id", F.lit("x")), str(tmp_path / "r"))
    assert load_report(spark, str(tmp_path / "r"), None).columns == ["genre_primary", "count"]


@pytest.fixture(scope="module")
def features(spark):
    from reelpulse.plans.catalog import Bound

    b = Bound(spark, SF001)
    return sg.user_features(b.fact_watch(), b.dim_date()).persist()


def test_user_features_fill_only_features(spark):
    watch = spark.createDataFrame(
        [(7, "s1", None, None, "2024011322"), (8, "s2", 10.0, 50.0, "2024011310")],
        "user_id long, session_id string, watch_duration_minutes double, progress_percentage double, date_key string",
    )
    dates = spark.createDataFrame([("2024011322", True), ("2024011310", False)], "date_key string, is_night boolean")
    out = {r["user_id"]: r for r in sg.user_features(watch, dates).collect()}
    assert dict(sg.user_features(watch, dates).dtypes)["user_id"] == "bigint"     # trap T11
    assert (out[7]["total_duration_minutes"], out[7]["avg_progress_percentage"], out[7]["night_view_ratio"]) == (0.0, 0.0, 1.0)


def test_segments_every_user_once(spark, features):
    seg = sg.user_segments(features)
    assert seg.count() == features.count() == seg.select("user_id").distinct().count()
    assert {r[0] for r in seg.select("segment_name").distinct().collect()} <= {sg.NIGHT_OWL, sg.MOVIE_BUFF, sg.CASUAL}
    again = sg.user_segments(features)
    assert rows(seg, "user_id", "cluster_id") == rows(again, "user_id", "cluster_id")   # fixed seed + layout


def test_name_clusters_argmax_with_ties(spark):
    cent = spark.createDataFrame(
        [(0, 1.0, 100.0, 1.0, 0.5), (1, 1.0, 300.0, 1.0, 0.5), (2, 1.0, 200.0, 1.0, 0.1)],
        "cluster_id int, total_views_center double, duration_center double, progress_center double, night_ratio_center double",
    )
    names = {r.cluster_id: r.segment_name for r in sg.cluster_names(cent).collect()}
    assert names == {0: sg.NIGHT_OWL, 1: sg.MOVIE_BUFF, 2: sg.CASUAL}   # tie on night ratio -> lowest id


def test_sweep_scores(spark, features):
    sweep = sg.kmeans_sweep(features, 2, 4).collect()
    assert [r["k"] for r in sweep] == [2, 3, 4]
    assert all(-1.0 <= r["silhouette"] <= 1.0 for r in sweep)
    assert sweep[-1]["cost"] <= sweep[0]["cost"]


def test_scaled_constant_feature_is_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, 1.0, 0.0), (2, 3.0, 5.0, 2.0, 1.0)],
                               "user_id long, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS))
    out = {r["user_id"]: r for r in sg.scaled_features(df).collect()}
    assert out[1]["z_total_duration_minutes"] == 0.0
    assert out[1]["z_total_views"] == -0.707107 and out[2]["z_total_views"] == 0.707107


def test_segment_views(spark, features):
    seg = sg.user_segments(features)
    counts = {r["segment_name"]: r["count"] for r in sv.segment_counts(seg).collect()}
    assert sum(counts.values()) == seg.count()
    assert sv.segment_lookup(seg, sg.NIGHT_OWL).count() == counts.get(sg.NIGHT_OWL, 0)
    assert sv.segment_lookup(seg).count() == seg.count()
    assert sv.segment_profile(seg).count() == len(counts)
    kpi = sv.kpi_summary(seg).first()
    assert kpi["total_users"] == seg.count()


def test_fewer_points_than_k(spark):
    import pytest

    df = spark.createDataFrame([(1, 1.0, 10.0, 50.0, 0.1), (2, 5.0, 90.0, 20.0, 0.9), (3, 5.0, 90.0, 20.0, 0.9)],
                               "user_id long, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS))
    with pytest.raises(sg.TooFewPoints, match="K=3.*only 2"):
        sg.cluster(df)
    sweep = sg.kmeans_sweep(df).collect()
    assert [r["k"] for r in sweep] == list(range(2, 9))
    assert sweep[0]["cost"] is not None and all(r["cost"] is None and r["silhouette"] is None for r in sweep[1:])


def test_two_clusters_are_named(spark):
    cent = spark.createDataFrame([(0, 1.0, 100.0, 1.0, 0.1), (1, 1.0, 300.0, 1.0, 0.5)],
                                 "cluster_id int, total_views_center double, duration_center double, "
                                 "progress_center double, night_ratio_center double")
    assert {r.cluster_id: r.segment_name for r in sg.cluster_names(cent).collect()} == {1: sg.NIGHT_OWL, 0: sg.MOVIE_BUFF}
    assert sg.cluster_names(cent.limit(0)).count() == 0


def test_kmeans_against_brute_force(spark, features):
    """Small fixture, brute force: every user sits in the cluster of its
    nearest fitted centre, and the centroid report is the per-cluster mean
    of the raw features."""
    import numpy as np

    centres, pred = sg.fit_clusters(features)
    pdf = pred.select("user_id", "cluster_id", "cost", *FEATURE_COLUMNS, "z").toPandas()
    centres = np.array(centres)
    z = np.stack(pdf["z"].to_numpy())
    distances = ((z[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    assert (np.argmin(distances, axis=1) == pdf["cluster_id"].to_numpy()).all()
    assert pdf["cost"].sum() == pytest.approx(distances.min(axis=1).sum(), rel=1e-9)
    # the centres are the means of their users: the fit has converged
    for c in range(3):
        assert centres[c] == pytest.approx(z[pdf["cluster_id"] == c].mean(axis=0), abs=1e-3)
    expected = pdf.groupby("cluster_id")[FEATURE_COLUMNS].mean()
    for r in sg.cluster_centroids(pred).collect():
        row = expected.loc[r["cluster_id"]]
        assert r["total_views_center"] == pytest.approx(round(row["total_views"], 2), abs=0.006)
        assert r["night_ratio_center"] == pytest.approx(round(row["night_view_ratio"], 4), abs=6e-5)


def test_clusters_do_not_depend_on_partitions(spark, features):
    results, seeds = [], []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (2, 8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            dealt = features.orderBy(F.rand(n)).repartition(n)
            seeds.append(sg.seed_points(sg.points(dealt), 8))
            results.append(rows(sg.cluster(dealt).select("user_id", "cluster_id")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
    assert seeds[0] == seeds[1] == seeds[2] and len({tuple(s) for s in seeds[0]}) == 8


def test_silhouette_against_all_pairs(spark):
    import random

    import numpy as np

    rnd = random.Random(2)
    data = [(i, [rnd.gauss(3 * (i % 4), 1) for _ in range(4)], i % 4) for i in range(60)] + [(99, [9.0] * 4, 7)]
    df = spark.createDataFrame(data, "user_id long, z array<double>, cluster_id int").repartition(5)
    z, label = np.array([r[1] for r in data]), np.array([r[2] for r in data])
    d = ((z[:, None, :] - z[None, :, :]) ** 2).sum(2)
    each = []
    for i in range(len(z)):
        own = label == label[i]
        if own.sum() == 1:
            each.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, label == c].mean() for c in set(label) - {label[i]})
        each.append((b - a) / max(a, b))
    assert sg.silhouette(df).first()[0] == pytest.approx(np.mean(each), rel=1e-9)
    assert sg.silhouette(df.filter("cluster_id = 1")).first()[0] is None
    assert sg.silhouette(df.limit(0)).first()[0] is None


def test_connector_formats_use_collections(spark, monkeypatch):
    """A document-store format is addressed by collection and upserts by
    key; checked on the writer calls (no connector jar here)."""
    from pyspark.sql.readwriter import DataFrameWriter

    from reelpulse.sources import io

    calls = []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, path=None, **kw: calls.append((self, path)))
    seen = []
    orig_option = DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: (seen.append((k, v)), orig_option(self, k, v))[1])
    df = spark.createDataFrame([("s1", "2024010100")], "session_id string, date_key string")
    io.write_serving(df, "/x/fact_watch_history", 3, "session_id", fmt="mongodb")
    io.publish_report(df, "/x/report_top_devices", fmt="mongodb")
    assert [p for _, p in calls] == [None, None]
    assert ("collection", "fact_watch_history") in seen and ("idFieldList", "session_id") in seen
    assert ("operationType", "replace") in seen and ("collection", "report_top_devices") in seen
