"""End-to-end jobs over files derived from the driver's sf0.001 tables."""

from pyspark.sql import functions as F

from reelpulse import jobs, schemas
from reelpulse.operators import reports as rp
from reelpulse.plans import bind
from reelpulse.sources import io
from reelpulse.streaming.ingest import _conform

from conftest import SF001, rows


def test_warehouse_reports_segments(spark, tmp_path):
    from reelpulse.plans.catalog import Bound

    b = Bound(spark, SF001)
    bind.users_raw(spark, SF001).write.option("header", True).csv(str(tmp_path / "users.csv"))
    bind.movies_raw(spark, SF001).write.option("header", True).csv(str(tmp_path / "movies.csv"))
    io.append_fact(_conform(b.watch(), schemas.WATCH_FACT), str(tmp_path / "landed/fact_watch_history"), 0)
    io.append_fact(_conform(b.search(), schemas.SEARCH_FACT), str(tmp_path / "landed/fact_search_logs"), 0)
    wh_root = str(tmp_path / "warehouse")
    jobs.build_warehouse(spark, str(tmp_path / "users.csv"), str(tmp_path / "movies.csv"),
                         str(tmp_path / "landed/fact_watch_history"), str(tmp_path / "landed/fact_search_logs"), wh_root)
    ri = {(r["fk"], r["fact"]): r["orphans"] for r in io.load_table(spark, f"{wh_root}/_quality/ri_report").collect()}
    assert ri[("user_id", "fact_watch_history")] == 0 and ri[("movie_id", "fact_watch_history")] > 0
    dq = {r["table"]: r["ok"] for r in io.load_table(spark, f"{wh_root}/_quality/dq_dimensions").collect()}
    assert dq == {"dim_users": True, "dim_movies": True, "dim_date": True}

    out = str(tmp_path / "reports")
    names = jobs.run_reports(spark, wh_root, out, watch=str(tmp_path / "landed/fact_watch_history"),
                             search=str(tmp_path / "landed/fact_search_logs"))
    assert len(names) == 6
    assert rows(io.load_table(spark, f"{out}/report_top_devices")) == rows(rp.top_devices(b.fact_watch()))

    seg = jobs.run_segments(spark, wh_root, out, watch=str(tmp_path / "landed/fact_watch_history"), sweep=False)
    users = io.load_table(spark, f"{out}/ml_user_segments")
    assert users.count() == users.select("user_id").distinct().count() > 0
    assert "ml_cluster_centroids" in seg

    # dashboard views: the live collections were never written -> batch only
    views = jobs.serving_views(spark, out)
    devices = dict(rows(views["device_totals"]))
    assert devices == dict(rows(io.load_table(spark, f"{out}/report_top_devices")))
    assert views["kpi"].first()["total_users"] == users.count()
    assert sum(r["count"] for r in views["segment_counts"].collect()) == users.count()


def test_telemetry_and_lakehouse_jobs(spark, tmp_path):
    bind.telemetry_raw(spark, SF001).write.option("header", True).csv(str(tmp_path / "tel.csv"))
    reports = jobs.run_telemetry(spark, str(tmp_path / "tel.csv"), str(tmp_path / "out"))
    funnel = {r["step"]: r["rows"] for r in io.load_table(spark, str(tmp_path / "out/telemetry_funnel")).collect()}
    assert funnel["raw"] == bind.telemetry_raw(spark, SF001).count()
    from reelpulse.operators.telemetry import clean_telemetry
    raw = io.read_csv(spark, str(tmp_path / "tel.csv"), schemas.TELEMETRY_RAW)
    assert funnel["valid_timestamp"] == clean_telemetry(raw).count()
    assert reports["telemetry_anomalies"].count() >= 0

    csvs = {}
    for name in ("orders", "items", "products", "reviews"):
        getattr(bind, f"{name}_csv")(spark, SF001).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
        csvs[name] = str(tmp_path / f"{name}.csv")
    gold = jobs.run_lakehouse(spark, csvs, str(tmp_path / "lake"))
    daily = spark.read.parquet(str(tmp_path / "lake/gold/sales_daily"))
    items = spark.read.parquet(str(tmp_path / "lake/silver/items"))
    assert "silver_processed_at" in items.columns and len(gold) == 3
    joined = items.join(spark.read.parquet(str(tmp_path / "lake/silver/orders")).select("order_id"), "order_id")
    assert daily.agg(F.sum("total_order_items_sold")).first()[0] == joined.count()


def test_cli_telemetry(spark, tmp_path, capsys):
    bind.telemetry_raw(spark, SF001).write.option("header", True).csv(str(tmp_path / "tel.csv"))
    assert jobs.main(["telemetry", "--csv", str(tmp_path / "tel.csv"), "--out", str(tmp_path / "out")]) == 0
    assert "valid_timestamp" in capsys.readouterr().out
    assert io.load_table(spark, str(tmp_path / "out/telemetry_top_users")).count() == 5


def test_stream_job(spark, tmp_path):
    from reelpulse.plans.catalog import Bound

    wh_root = str(tmp_path / "warehouse")
    Bound(spark, SF001).dim_movies().write.parquet(f"{wh_root}/dim_movies")
    bind.clickstream_json(spark, SF001).select("value").repartition(2).write.text(str(tmp_path / "landing"))
    layer = jobs.run_stream(spark, "text", {"maxFilesPerTrigger": "1"}, wh_root, str(tmp_path / "reports"),
                            str(tmp_path / "chk"), path=str(tmp_path / "landing"), trigger={"availableNow": True})
    try:
        for q in layer.queries:
            q.awaitTermination(180)
    finally:
        layer.stop()
        spark.streams.resetTerminated()
    # the running job keeps its batch log and progress, and its facts can be compacted
    assert layer.listener is None
    logged = io.read_batches(spark, str(tmp_path / "chk/batch_log"), schemas.BATCH_STATS)
    assert logged.filter("event_type = 'watch'").agg(F.sum("count")).first()[0] == io.read_fact(
        spark, f"{wh_root}/fact_watch_history", "watch").count()
    progress = spark.read.parquet(str(tmp_path / "chk/progress"))
    assert {"ingest", "genre_hot", "device_hot"} == {r[0] for r in progress.select("query_name").distinct().collect()}
    assert progress.filter("query_name = 'ingest'").agg(F.sum("malformed")).first()[0] > 0
    before = rows(io.read_fact(spark, f"{wh_root}/fact_watch_history", "watch"))
    assert jobs.main(["compact", "--warehouse", wh_root, "--reports", str(tmp_path / "reports"), "--grace-hours", "0"]) == 0
    assert rows(io.read_fact(spark, f"{wh_root}/fact_watch_history", "watch")) == before
    watch = io.read_fact(spark, f"{wh_root}/fact_watch_history", "watch")
    devices = io.load_report(spark, str(tmp_path / "reports/report_top_devices_stream"),
                             "device_type string, count long")
    assert devices.agg(F.sum("count")).first()[0] == watch.count() > 0
    assert rows(io.read_fact(spark, str(tmp_path / "reports/fact_watch_history"), "watch")) == rows(watch)


def test_cli_serve_with_nothing_published(spark, tmp_path, capsys):
    assert jobs.main(["serve", "--reports", str(tmp_path / "empty")]) == 0
    out = capsys.readouterr().out
    assert "== genre_totals" in out and "== kpi" in out


def test_batch_and_live_totals_count_every_event_once(spark, tmp_path):
    """Reports up to the cut and live counts from the cut on, over one stream."""
    from reelpulse.plans.catalog import Bound

    cut = "2024-01-16 00:00:00"
    b = Bound(spark, SF001)
    root = str(tmp_path / "warehouse")
    b.dim_movies().write.parquet(f"{root}/dim_movies")
    b.dim_date().write.parquet(f"{root}/dim_date")
    bind.clickstream_json(spark, SF001).select("value").write.text(str(tmp_path / "landing"))
    reports = str(tmp_path / "reports")
    layer = jobs.run_stream(spark, "text", {}, root, reports, str(tmp_path / "chk"), path=str(tmp_path / "landing"),
                            trigger={"availableNow": True}, since=cut)
    try:
        for q in layer.queries:
            q.awaitTermination(180)
    finally:
        layer.stop()
        spark.streams.resetTerminated()
    watch = io.read_fact(spark, f"{root}/fact_watch_history", "watch")
    jobs.run_reports(spark, root, reports, until=cut)
    views = jobs.serving_views(spark, reports)
    assert views["device_totals"].agg(F.sum("total")).first()[0] == watch.count()
    known = watch.join(b.dim_movies().select(F.col("movie_id").cast("string").alias("movie_id")), "movie_id").count()
    assert views["genre_totals"].agg(F.sum("total")).first()[0] == known
    live = io.load_report(spark, f"{reports}/report_top_devices_stream", "device_type string, count long")
    assert 0 < live.agg(F.sum("count")).first()[0] < watch.count()


def test_cut_must_be_a_full_hour():
    import pytest

    assert jobs._cut_key("2024-01-16 05:00:00") == "2024011605"
    with pytest.raises(ValueError):
        jobs._cut_key("2024-01-16 05:30:00")


def test_social_and_publish_jobs(spark, tmp_path):
    for name, df in (("users", bind.social_users_csv(spark, SF001)), ("posts", bind.social_posts_csv(spark, SF001)),
                     ("watch", bind.watch_history_csv(spark, SF001)), ("search", bind.search_logs_csv(spark, SF001))):
        df.write.option("header", True).csv(str(tmp_path / name))
    bind.social_feeds(spark, SF001).write.parquet(str(tmp_path / "feeds"))
    out = str(tmp_path / "out")
    names = jobs.run_social(spark, str(tmp_path / "users"), str(tmp_path / "posts"), str(tmp_path / "feeds"), out,
                            as_of="2024-06-30")
    assert set(names) == {"users", "posts", "action_distribution", "top_categories", "top_users", "top_users_detail"}
    assert io.load_table(spark, f"{out}/users").count() == spark.read.parquet(f"{SF001}/customer.parquet").count()
    assert io.load_table(spark, f"{out}/top_users").count() == 5

    from reelpulse.operators import events as ev

    publish = ["publish", "--watch", str(tmp_path / "watch"), "--search", str(tmp_path / "search"), "--target", str(tmp_path / "landing")]
    for _ in range(2):  # the second run finds its events published
        assert jobs.main(publish) == 0
    lines = spark.read.text(str(tmp_path / "landing"))
    back = ev.parse_events(lines)
    cleaned = ev.normalize_watch(bind.watch_history_csv(spark, SF001)).filter("user_id is not null").count()
    assert ev.route(back, "watch").count() == cleaned
    assert back.filter("ts is null or (session_id is null and search_id is null)").count() == 0
    n = lines.count()
    assert jobs.run_publish(spark, str(tmp_path / "watch"), str(tmp_path / "search"), str(tmp_path / "landing"), run="second")
    assert spark.read.text(str(tmp_path / "landing")).count() == 2 * n


def test_warehouse_checks_what_it_wrote(spark, tmp_path):
    import pytest

    bind.movies_raw(spark, SF001).limit(0).write.option("header", True).csv(str(tmp_path / "movies"))
    bind.users_raw(spark, SF001).write.option("header", True).csv(str(tmp_path / "users"))
    from reelpulse.plans.catalog import Bound

    Bound(spark, SF001).fact_watch().write.partitionBy("date_key").parquet(str(tmp_path / "watch"))
    Bound(spark, SF001).fact_search().write.partitionBy("date_key").parquet(str(tmp_path / "search"))
    with pytest.raises(RuntimeError, match="dim_movies"):
        jobs.build_warehouse(spark, str(tmp_path / "users"), str(tmp_path / "movies"), str(tmp_path / "watch"),
                             str(tmp_path / "search"), str(tmp_path / "out"))
