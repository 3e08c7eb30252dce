"""End-to-end jobs, one per pipeline of the reference, over real paths.

    python -m reelpulse.jobs warehouse --users users.csv --movies movies.csv \\
        --watch <fact_watch_history> --search <fact_search_logs> --out <warehouse>
    python -m reelpulse.jobs reports --warehouse <warehouse> --out <reports> [--format parquet]
    python -m reelpulse.jobs segments --warehouse <warehouse> --out <reports>
    python -m reelpulse.jobs telemetry --csv video_streaming.csv [--out <reports>]
    python -m reelpulse.jobs lakehouse --orders o.csv --items i.csv --products p.csv --reviews r.csv --root <lake>
    python -m reelpulse.jobs social --users u.csv --posts p.csv --feeds <feeds> --out <reports>
    python -m reelpulse.jobs publish --watch watch.csv --search search.csv --target <landing>
    python -m reelpulse.jobs serve --reports <reports> [--segment <name>]
    python -m reelpulse.jobs compact --warehouse <warehouse> [--reports <reports>]
    python -m reelpulse.jobs stream --source kafka --option kafka.bootstrap.servers=host:9092 \\
        --option subscribe=video-clickstream --warehouse <warehouse> --reports <reports>

Every job reads and writes through ``sources.io``; formats are options
(``delta`` or a document-store connector where installed).  Reports are
published with one action each.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpulse import schemas
from reelpulse.functions.columns import EVENT_TIME_FORMAT
from reelpulse.operators import events as ev
from reelpulse.operators import lakehouse as lh
from reelpulse.operators import quality as dq
from reelpulse.operators import reports as rp
from reelpulse.operators import segment as sg
from reelpulse.operators import social as so
from reelpulse.operators import telemetry as tm
from reelpulse.operators import warehouse as wh
from reelpulse.session import scratch_dir
from reelpulse.sources import fs, io, manifest
from reelpulse.streaming import ingest as st


def build_warehouse(spark: SparkSession, users_csv: str, movies_csv: str, watch_path: str,
                    search_path: str, out: str) -> dict[str, DataFrame]:
    """CSV dimensions + landed facts -> star schema under ``out``:
    dim_users, dim_movies, dim_date, plus quality reports
    (``written_rows`` of the re-read dimensions, ``dq_dimensions``,
    ``ri_report``).  A dimension that reads back empty is an error.  Dimensions are registered as
    global views for other sessions of this application."""
    users = wh.dim_users(io.read_csv(spark, users_csv, schemas.USERS_RAW))
    movies = wh.dim_movies(io.read_csv(spark, movies_csv, schemas.MOVIES_RAW))
    watch = io.read_fact(spark, watch_path, "watch")
    search = io.read_fact(spark, search_path, "search")
    io.save_dimension(users, f"{out}/dim_users")
    io.save_dimension(movies, f"{out}/dim_movies")
    io.save_dimension(wh.dim_date(watch, search), f"{out}/dim_date")
    stored = {name: io.load_table(spark, f"{out}/{name}") for name in ("dim_users", "dim_movies", "dim_date")}
    counts = {name: io.verify_written(spark, f"{out}/{name}") for name in stored}
    io.publish_report(spark.createDataFrame(sorted(counts.items()), "table string, rows long"),
                      f"{out}/_quality/written_rows")
    empty = [name for name, n in counts.items() if not n]
    if empty:
        raise RuntimeError(f"written without rows: {', '.join(empty)}")
    stored["fact_watch"], stored["fact_search"] = watch, search
    checks = dq.dimension_report({
        "dim_users": (stored["dim_users"], "user_id"),
        "dim_movies": (stored["dim_movies"], "movie_id"),
        "dim_date": (stored["dim_date"], "date_key"),
    })
    io.publish_report(checks, f"{out}/_quality/dq_dimensions")
    ri = dq.ri_report([
        ("fact_watch_history", watch, "user_id", "dim_users", stored["dim_users"], "user_id"),
        ("fact_watch_history", watch, "movie_id", "dim_movies", stored["dim_movies"], "movie_id"),
        ("fact_watch_history", watch, "date_key", "dim_date", stored["dim_date"], "date_key"),
        ("fact_search_logs", search, "user_id", "dim_users", stored["dim_users"], "user_id"),
        ("fact_search_logs", search, "date_key", "dim_date", stored["dim_date"], "date_key"),
    ])
    io.publish_report(ri, f"{out}/_quality/ri_report")
    wh.register_global_views(spark, stored)
    return stored


def _warehouse(spark: SparkSession, root: str, watch: str | None = None, search: str | None = None):
    return (
        io.read_fact(spark, watch or f"{root}/fact_watch_history", "watch"),
        io.read_fact(spark, search or f"{root}/fact_search_logs", "search"),
        io.load_table(spark, f"{root}/dim_movies"),
        io.load_table(spark, f"{root}/dim_date"),
    )


def run_reports(spark: SparkSession, warehouse: str, out: str, fmt: str = "parquet",
                watch: str | None = None, search: str | None = None, until: str | None = None) -> list[str]:
    """The six BI reports, each published once.

    ``until`` (a full hour, ``yyyy-MM-dd HH:mm:ss``) ends the two reports that
    serving adds to the live counts where the live counts begin (``since`` of
    the stream job), so that no event is counted twice.
    """
    fact_watch, fact_search, movies, dates = _warehouse(spark, warehouse, watch, search)
    batch_side = fact_watch if until is None else fact_watch.filter(F.col("date_key") < _cut_key(until))
    reports = {
        "report_top_devices": rp.top_devices(batch_side),
        "report_genre_popularity": rp.genre_popularity(batch_side, movies),
        "report_peak_hours": rp.peak_hours(fact_watch, dates),
        "report_binge_genres": rp.binge_genres(fact_watch, dates, movies),
        "report_churn_risk": rp.churn_risk(fact_watch),
        "report_failed_searches": rp.failed_searches(fact_search),
    }
    for name, df in reports.items():
        io.publish_report(df, f"{out}/{name}", fmt)
    return list(reports)


def _cut_key(moment: str) -> str:
    """Hour key of a cut between the batch and the live side."""
    at = datetime.strptime(moment, "%Y-%m-%d %H:%M:%S")
    if at.minute or at.second:
        raise ValueError(f"the cut {moment} is not a full hour")
    return at.strftime("%Y%m%d%H")


def run_segments(spark: SparkSession, warehouse: str, out: str, fmt: str = "parquet",
                 watch: str | None = None, sweep: bool = True) -> list[str]:
    """Features -> K sweep (scores published) -> K-Means -> named segments."""
    fact_watch = io.read_fact(spark, watch or f"{warehouse}/fact_watch_history", "watch")
    dates = io.load_table(spark, f"{warehouse}/dim_date")
    io.save_dimension(sg.user_features(fact_watch, dates), f"{out}/ml_user_features")
    features = io.load_table(spark, f"{out}/ml_user_features")
    written = []
    if sweep:
        io.publish_report(sg.kmeans_sweep(features), f"{out}/ml_kmeans_sweep", fmt)
        written.append("ml_kmeans_sweep")
    io.save_dimension(sg.cluster(features), f"{out}/ml_clusters")
    clusters = io.load_table(spark, f"{out}/ml_clusters")
    io.publish_report(sg.named_segments(clusters), f"{out}/ml_user_segments", fmt)
    io.publish_report(sg.cluster_centroids(clusters), f"{out}/ml_cluster_centroids", fmt)
    return written + ["ml_user_segments", "ml_cluster_centroids"]


def run_telemetry(spark: SparkSession, csv: str, out: str | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Clean a dirty telemetry CSV and build its reports."""
    raw = io.read_csv(spark, csv, schemas.TELEMETRY_RAW)
    # the clean table is stored once, so the reports do not each repeat the de-duplication
    kept = f"{out}/telemetry_clean" if out else scratch_dir(spark, "telemetry_clean", unique=True)
    io.save_dimension(tm.clean_telemetry(raw), kept)
    clean = io.load_table(spark, kept)
    reports = {
        "telemetry_funnel": tm.cleaning_funnel(raw),
        "telemetry_top_users": tm.top_users(clean),
        "telemetry_trending_videos": tm.trending_videos(clean),
        "telemetry_peak_hours": tm.activity_by_hour(clean),
        "telemetry_genre_stats": tm.genre_watch_stats(clean),
        "telemetry_anomalies": tm.anomalies(clean),
    }
    if out:
        for name, df in reports.items():
            io.publish_report(df, f"{out}/{name}", fmt)
    return reports


def run_social(spark: SparkSession, users_csv: str, posts_csv: str, feeds: str, out: str,
               as_of: str | None = None, fmt: str = "parquet", feeds_fmt: str = "parquet") -> list[str]:
    """Load the social documents (typed, ages as of a day, today by default)
    and publish the collections and their rollups."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    users = so.load_social_users(io.read_csv(spark, users_csv, schemas.SOCIAL_USERS_RAW), day)
    posts = so.load_social_posts(io.read_csv(spark, posts_csv, schemas.SOCIAL_POSTS_RAW))
    actions = spark.read.format(feeds_fmt).load(feeds)
    collections = {
        "users": users, "posts": posts,
        "action_distribution": so.action_distribution(actions),
        "top_categories": so.top_categories(posts),
        "top_users": so.top_active_users(actions),
        "top_users_detail": so.top_active_users_detail(actions, users),
    }
    for name, df in collections.items():
        io.publish_report(df, f"{out}/{name}", fmt)
    return list(collections)


def run_publish(spark: SparkSession, watch_csv: str, search_csv: str, target: str, fmt: str = "text",
                options: dict | None = None, run: str | None = None) -> bool:
    """Clean the raw producer rows and publish them as JSON events, stamped
    with the time of the run.  ``run`` names the publication (by default the input
    files as they are now): a rerun of the same one publishes nothing and returns
    False."""
    now = F.date_format(F.current_timestamp(), EVENT_TIME_FORMAT)
    raw = io.read_raw_csv(spark, watch_csv), io.read_raw_csv(spark, search_csv)
    watch = ev.normalize_watch(raw[0]).withColumn("current_timestamp", now)
    search = ev.normalize_search(raw[1]).withColumn("current_timestamp", now)
    run = run or fs.fingerprint(spark, [f for df in raw for f in df.inputFiles()])
    return io.publish_events([(watch, "session_id"), (search, "search_id")], target, run, fmt, options)


def run_compact(spark: SparkSession, warehouse: str, reports: str | None = None,
                grace_seconds: float = 86_400) -> dict[str, int]:
    """Fold the landed batches of both facts (with ``reports``, of their serving
    copies too), and remove what no version within the grace period names.
    Returns the number of folded batches per table.  It may run beside the stream."""
    folded = {}
    for root in filter(None, (warehouse, reports)):
        for name, kind in (("fact_watch_history", "watch"), ("fact_search_logs", "search")):
            path = f"{root}/{name}"
            state = manifest.latest(spark, path)
            if state is None:
                continue
            folded[path] = len(state.batches)
            if state.batches:
                st.compact(spark, path, kind=kind)
            io.expire_folded(spark, path, grace_seconds)
    return folded


def run_lakehouse(spark: SparkSession, csvs: dict[str, str], root: str, fmt: str = "parquet") -> list[str]:
    """Bronze (raw text) -> silver (typed, schema-locked) -> gold KPIs; every
    layer is re-read from storage, as a lakehouse job does."""
    silver_ops = {"orders": lh.silver_orders, "items": lh.silver_items,
                  "products": lh.silver_products, "reviews": lh.silver_reviews}
    for name, path in csvs.items():
        io.write_layer(lh.to_bronze(io.read_raw_csv(spark, path)), root, "bronze", name, fmt)
    for name, op in silver_ops.items():
        bronze = io.read_layer(spark, root, "bronze", name, fmt)
        io.write_layer(op(bronze), root, "silver", name, fmt, lock_schema=True)
    s = {name: io.read_layer(spark, root, "silver", name, fmt) for name in silver_ops}
    gold = {
        "sales_daily": lh.sales_daily(s["orders"], s["items"]),
        "category_performance": lh.category_performance(s["items"], s["products"]),
        "product_satisfaction": lh.product_satisfaction(s["reviews"], s["items"], s["products"]),
    }
    for name, df in gold.items():
        io.write_layer(df, root, "gold", name, fmt)
    return list(gold)


def serving_views(spark: SparkSession, reports: str, fmt: str = "parquet",
                  segment: str | None = None) -> dict[str, DataFrame]:
    """What the dashboard shows, from the published collections: batch +
    live genre and device totals, the KPI header, the segment views, the list
    of segment names and the users of one ``segment`` (of all, without one).
    The totals count every event once if the batch reports end (``until``)
    where the live counts begin (``since``).
    A collection that was never written reads as empty (with its schema),
    so either layer alone still renders."""
    from reelpulse.operators import serving as sv

    def load(name, ddl):
        return io.load_report(spark, f"{reports}/{name}", ddl, fmt)

    genre_batch = load("report_genre_popularity", "genre_primary string, watch_count long")
    genre_live = load("report_genre_popularity_stream", "genre_primary string, count long")
    device_batch = load("report_top_devices", "device_type string, total_views long")
    device_live = load("report_top_devices_stream", "device_type string, count long")
    segments = load("ml_user_segments", "user_id long, total_views double, total_duration_minutes double, "
                    "avg_progress_percentage double, night_view_ratio double, cluster_id int, segment_name string")
    return {
        "genre_totals": sv.merge_batch_speed(genre_batch, genre_live, "genre_primary", "watch_count"),
        "device_totals": sv.merge_batch_speed(device_batch, device_live, "device_type", "total_views"),
        "kpi": sv.kpi_summary(segments),
        "segment_counts": sv.segment_counts(segments),
        "segment_profile": sv.segment_profile(segments),
        "segment_names": sv.segment_names(segments),
        "segment_lookup": sv.segment_lookup(segments, segment),
    }


def run_stream(spark: SparkSession, source: str, options: dict, warehouse: str, reports: str,
               checkpoints: str, path: str | None = None, trigger: dict | None = None,
               timeout: float | None = None, since: str | None = None, serving_fmt: str = "parquet",
               serving_options: dict | None = None, report_fmt: str = "parquet",
               report_options: dict | None = None):
    """The speed layer: ingest + live genre and device counts until any
    query ends (or ``timeout`` seconds).  ``since`` starts the live counts
    where the batch reports end; the serving copy and the live reports may
    each go to a document store.  The ingest's counts per event kind and the
    progress of all queries, with the rejected records of each batch, are kept
    below ``checkpoints``.  Call ``stop`` on the returned layer."""
    if since is not None:
        _cut_key(since)
    paths = st.IngestPaths(
        watch=f"{warehouse}/fact_watch_history", search=f"{warehouse}/fact_search_logs",
        serving_watch=f"{reports}/fact_watch_history", serving_search=f"{reports}/fact_search_logs",
        checkpoint=f"{checkpoints}/combined_stream",
    )

    def movies():
        return wh.load_static_movies(spark, f"{warehouse}/dim_movies", f"{warehouse}/movies.csv")

    def dimension_version():
        state = manifest.latest(spark, f"{warehouse}/dim_movies")
        return None if state is None else state.version

    listener = st.MetricsListener(spark, f"{checkpoints}/progress", flush_every=100)
    spark.streams.addListener(listener)
    try:
        layer = st.start_speed_layer(
            spark, st.event_stream(spark, source, path, options), movies, paths,
            f"{reports}/report_genre_popularity_stream", f"{reports}/report_top_devices_stream", checkpoints, trigger,
            serving_fmt, serving_options, report_fmt, report_options, since,
            log=st.BatchLog(f"{checkpoints}/batch_log"), dimension_version=dimension_version,
        )
    except Exception:
        spark.streams.removeListener(listener)
        raise
    layer.listener = listener
    layer.await_any(spark, timeout)
    return layer


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="reelpulse.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    w = sub.add_parser("warehouse")
    for a in ("users", "movies", "watch", "search", "out"):
        w.add_argument(f"--{a}", required=True)
    r = sub.add_parser("reports")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--format", default="parquet")
    r.add_argument("--until", help="end of the batch side of the served totals, a full hour")
    g = sub.add_parser("segments")
    g.add_argument("--warehouse", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--format", default="parquet")
    t = sub.add_parser("telemetry")
    t.add_argument("--csv", required=True)
    t.add_argument("--out")
    lk = sub.add_parser("lakehouse")
    for a in ("orders", "items", "products", "reviews", "root"):
        lk.add_argument(f"--{a}", required=True)
    lk.add_argument("--format", default="parquet")
    v = sub.add_parser("serve")
    v.add_argument("--reports", required=True)
    v.add_argument("--format", default="parquet")
    v.add_argument("--segment")
    so_ = sub.add_parser("social")
    for a in ("users", "posts", "feeds", "out"):
        so_.add_argument(f"--{a}", required=True)
    so_.add_argument("--as-of")
    so_.add_argument("--format", default="parquet")
    pb = sub.add_parser("publish")
    for a in ("watch", "search", "target"):
        pb.add_argument(f"--{a}", required=True)
    pb.add_argument("--format", default="text")
    pb.add_argument("--option", action="append", default=[])
    pb.add_argument("--run", help="name of this publication; a second one of the same name is refused")
    cp = sub.add_parser("compact")
    cp.add_argument("--warehouse", required=True)
    cp.add_argument("--reports")
    cp.add_argument("--grace-hours", type=float, default=24)
    s = sub.add_parser("stream")
    s.add_argument("--source", default="kafka")
    s.add_argument("--path")
    s.add_argument("--option", action="append", default=[])
    s.add_argument("--warehouse", required=True)
    s.add_argument("--reports", required=True)
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--timeout", type=float)
    s.add_argument("--since", help="start of the live counts, a full hour")
    s.add_argument("--serving-format", default="parquet")
    s.add_argument("--serving-option", action="append", default=[])
    s.add_argument("--report-format", default="parquet")
    s.add_argument("--report-option", action="append", default=[])
    args = ap.parse_args(argv)

    def pairs(options):
        return dict(o.split("=", 1) for o in options)

    from reelpulse.session import build_session

    spark = build_session(app=f"reelpulse-{args.job}")
    if args.job == "warehouse":
        build_warehouse(spark, args.users, args.movies, args.watch, args.search, args.out)
    elif args.job == "reports":
        run_reports(spark, args.warehouse, args.out, args.format, until=args.until)
    elif args.job == "segments":
        run_segments(spark, args.warehouse, args.out, args.format)
    elif args.job == "telemetry":
        reports = run_telemetry(spark, args.csv, args.out)
        reports["telemetry_funnel"].show(truncate=False)
    elif args.job == "lakehouse":
        run_lakehouse(spark, {"orders": args.orders, "items": args.items, "products": args.products,
                              "reviews": args.reviews}, args.root, args.format)
    elif args.job == "serve":
        for name, df in serving_views(spark, args.reports, args.format, args.segment).items():
            print(f"== {name}")
            df.show(20, truncate=False)
    elif args.job == "social":
        run_social(spark, args.users, args.posts, args.feeds, args.out, args.as_of, args.format)
    elif args.job == "publish":
        if not run_publish(spark, args.watch, args.search, args.target, args.format, pairs(args.option), args.run):
            print("already published")
    elif args.job == "compact":
        for path, n in run_compact(spark, args.warehouse, args.reports, args.grace_hours * 3600).items():
            print(f"{path}: {n} batches folded")
    elif args.job == "stream":
        layer = run_stream(spark, args.source, pairs(args.option), args.warehouse, args.reports, args.checkpoints,
                   path=args.path, timeout=args.timeout, since=args.since,
                   serving_fmt=args.serving_format, serving_options=pairs(args.serving_option),
                   report_fmt=args.report_format, report_options=pairs(args.report_option))
        layer.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
