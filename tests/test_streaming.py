import json

from pyspark.sql import functions as F

from reelpulse.operators import events as ev
from reelpulse.sources import io
from reelpulse.streaming import ingest as st

from conftest import plan_text, rows


def _event(i, kind):
    base = {"event_type": kind, "user_id": f"u{i % 3}", "current_timestamp": f"2024-01-0{1 + i % 3} {10 + i % 12}:00:00",
            "device_type": ["TV", "Mobile"][i % 2], "location_country": "VN"}
    if kind == "watch":
        base.update(session_id=f"s{i}", movie_id=str(i % 4), watch_duration_minutes=float(i), action="paused",
                    quality="HD", user_rating=i % 5)
    else:
        base.update(search_id=f"q{i}", search_query=f"q{i % 3}", results_returned=i % 2, had_typo="False")
    return json.dumps(base)


def _land(tmp_path, chunks):
    d = tmp_path / "landing"
    d.mkdir(exist_ok=True)
    import os
    import time

    for n, lines in chunks:
        f = d / f"part-{n:03d}.json"
        f.write_text("\n".join(lines) + "\n")
        # the file source takes files oldest first: make the order explicit
        t = time.time() - 1000 + n
        os.utime(f, (t, t))
    return str(d)


def _movies(spark):
    return spark.createDataFrame([(0, 30.0, "Drama"), (1, 60.0, "Comedy"), (2, 0.0, "Drama")],
                                 "movie_id long, duration_minutes double, genre_primary string")


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_path):
    lines = [_event(i, "watch" if i % 3 else "search") for i in range(40)] + ["not json"]
    landing = _land(tmp_path, [(0, lines[:20]), (1, lines[20:])])
    paths = st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s"),
                           serving_watch=str(tmp_path / "sw"), checkpoint=str(tmp_path / "chk"))
    log = st.BatchLog(str(tmp_path / "log"))
    q = st.start_ingest(st.refine(st.event_stream(spark, "text", landing, max_per_trigger=1)),
                        lambda: _movies(spark), paths, trigger={"availableNow": True}, log=log)
    q.awaitTermination()
    assert log.frame(spark).select("batch_id").distinct().count() == 2   # two micro-batches

    batch = ev.parse_events(spark.read.text(landing))
    expected_watch = ev.watch_facts(ev.route(batch, "watch"), _movies(spark))
    got_watch = io.read_fact(spark, paths.watch, "watch")
    assert rows(got_watch) == rows(expected_watch)
    assert rows(io.read_fact(spark, paths.serving_watch, "watch")) == rows(got_watch)   # both stores agree
    assert io.read_fact(spark, paths.search, "search").count() == ev.route(batch, "search").count()

    # a retried micro-batch 0 is refused: nothing doubles
    first = ev.parse_events(spark.read.text(f"{landing}/part-000.json"))
    st.batch_writer(lambda: _movies(spark), paths)(first, 0)
    assert rows(io.read_fact(spark, paths.watch, "watch")) == rows(expected_watch)

    # restart on the same checkpoint picks up only new files
    _land(tmp_path, [(2, [_event(100, "watch")])])
    q = st.start_ingest(st.refine(st.event_stream(spark, "text", landing, max_per_trigger=1)),
                        lambda: _movies(spark), paths, trigger={"availableNow": True})
    q.awaitTermination()
    assert io.read_fact(spark, paths.watch, "watch").count() == expected_watch.count() + 1


def test_live_counts_complete_mode(spark, tmp_path):
    lines = [_event(i, "watch") for i in range(12)]
    landing = _land(tmp_path, [(0, lines[:6]), (1, lines[6:])])
    watch = st.refine(st.event_stream(spark, "text", landing, max_per_trigger=1)).filter(F.col("event_type") == "watch")
    report = str(tmp_path / "genre")
    q = st.start_live_count(st.live_genre_counts(watch, _movies(spark)), report, str(tmp_path / "chk"),
                            trigger={"availableNow": True})
    q.awaitTermination()
    batch = ev.parse_events(spark.read.text(landing))
    expected = st.live_genre_counts(ev.route(batch, "watch"), _movies(spark))
    assert rows(io.load_report(spark, report, "genre_primary string, count long")) == rows(expected)      # unknown movie -> null genre row


def test_metrics_listener(spark, tmp_path):
    landing = _land(tmp_path, [(0, [_event(i, "watch") for i in range(5)])])
    listener = st.MetricsListener(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(listener)
    try:
        q = (st.refine(st.event_stream(spark, "text", landing)).writeStream.format("noop")
             .option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).queryName("m").start())
        q.awaitTermination()
        import time
        for _ in range(50):
            if listener.rows:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    df = listener.to_frame(spark)
    assert df.agg(F.sum("input_rows")).first()[0] == 5
    # a batch reported again, as after a restart, stays one row
    listener.log.add(spark, [tuple(r) for r in df.collect()])
    assert rows(listener.to_frame(spark)) == rows(df)


def test_compaction_keeps_rows(spark, tmp_path):
    from reelpulse import schemas

    df = spark.createDataFrame([(str(i), "u", "m", "TV", 1.0, 1.0, "a", "HD", 1, "VN", f"20240101{i % 3:02d}")
                                for i in range(30)], schemas.WATCH_FACT)
    for b in range(3):
        io.append_fact(df.filter(F.col("session_id").cast("int") % 3 == b), str(tmp_path / "f"), b)
    out = st.compact(spark, str(tmp_path / "f"), str(tmp_path / "f2"))
    assert rows(io.read_fact(spark, out, "watch")) == rows(df) == rows(io.read_fact(spark, str(tmp_path / "f"), "watch"))
    assert len(spark.read.parquet(out).inputFiles()) == 3                 # one file per hour key


def test_speed_layer_three_queries(spark, tmp_path):
    lines = [_event(i, "watch" if i % 4 else "search") for i in range(16)]
    landing = _land(tmp_path, [(0, lines[:8]), (1, lines[8:])])
    paths = st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s"), checkpoint=str(tmp_path / "chk/main"))
    layer = st.start_speed_layer(
        spark, st.event_stream(spark, "text", landing, max_per_trigger=1), lambda: _movies(spark), paths,
        str(tmp_path / "genre"), str(tmp_path / "device"), str(tmp_path / "chk"), trigger={"availableNow": True})
    try:
        for q in layer.queries:
            q.awaitTermination(120)
        assert layer.await_any(spark, 1)
    finally:
        layer.stop()
        spark.streams.resetTerminated()
    watch_n = io.read_fact(spark, paths.watch, "watch").count()
    for name in ("device", "genre"):
        report = io.load_report(spark, str(tmp_path / name), "key string, count long")
        assert report.agg(F.sum("count")).first()[0] == watch_n


def test_hot_hour_is_spread_over_tasks(spark, tmp_path):
    from reelpulse.sources.io import spread_hot_keys

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "2024010100").otherwise(F.concat(F.lit("20240101"), F.lpad((F.col("id") % 23 + 1).cast("string"), 2, "0"))).alias("date_key"),
        F.col("id"))
    spread = spread_hot_keys(df, "date_key", rows_per_task=200)
    per_task = spread.filter(F.col("date_key") == "2024010100").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 1000     # hot hour (1000 rows) split
    assert spread.count() == 3000


def test_compaction_splits_a_hot_hour(spark, tmp_path):
    from reelpulse import schemas

    df = spark.range(30000).select(
        F.col("id").cast("string").alias("session_id"), F.lit("u").alias("user_id"), F.lit("m").alias("movie_id"),
        F.lit("TV").alias("device_type"), F.col("id").cast("double").alias("watch_duration_minutes"),
        F.lit(1.0).alias("progress_percentage"), F.lit("a").alias("action"), F.lit("HD").alias("quality"),
        F.lit(1).alias("user_rating"), F.lit("VN").alias("location_country"),
        F.when(F.col("id") % 3 == 0, "2024010100").otherwise(
            F.concat(F.lit("202401"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit("05"))).alias("date_key"),
    ).select(*[f.name for f in schemas.WATCH_FACT.fields])
    # the hot hour arrives over several micro-batches (several files)
    for b in range(6):
        io.append_fact(df.filter(F.col("session_id").cast("long") % 6 == b), str(tmp_path / "f"), b)
    # AQE splits a skewed partition at map-task boundaries: one file per split
    confs = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1k"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = st.compact(spark, str(tmp_path / "f"), str(tmp_path / "f2"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hot = [f for f in spark.read.parquet(out).inputFiles() if "date_key=2024010100" in f]
    assert len(hot) > 1                                           # the hot hour is split
    assert io.read_fact(spark, out, "watch").count() == 30000


def test_pinned_dimension_loads_once(spark):
    calls = []

    def loader():
        calls.append(1)
        return _movies(spark)

    load = st.pinned(loader)
    assert load() is load() and len(calls) == 1


def test_hot_hour_is_spread_beside_many_keys(spark):
    from reelpulse.sources.io import spread_hot_keys

    hot = spark.range(40_000).select(F.lit("hot").alias("k"), "id")
    many = spark.range(120_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), "id")
    out = spread_hot_keys(hot.unionByName(many), "k", rows_per_task=2000)
    per_task = out.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 4 and max(r["count"] for r in per_task) < 20_000
    assert out.count() == 160_000


def test_readers_list_only_the_snapshot_and_newer_batches(spark, tmp_path):
    from reelpulse import schemas
    from reelpulse.sources import fs

    path = str(tmp_path / "fact")

    def land(batch):
        rows_ = [(f"s{batch}_{i}", "u", "m", "TV", 1.0, 1.0, "view", "HD", 1, "X", f"20240101{i:02d}") for i in range(3)]
        io.append_fact(spark.createDataFrame(rows_, schemas.WATCH_FACT), path, batch)

    def listed():
        return {f.split("/fact/")[1].split("/")[0] for f in io.read_fact(spark, path).inputFiles() if "/fact/" in f}

    for batch in range(3):
        land(batch)
    assert listed() == {"batch_id=0", "batch_id=1", "batch_id=2"}
    st.compact(spark, path, str(tmp_path / "snapshot"))
    assert listed() == set() and io.read_fact(spark, path).count() == 9
    land(3)
    assert listed() == {"batch_id=3"} and io.read_fact(spark, path).count() == 12
    assert io.expire_folded(spark, path) == 0  # still within the grace period
    assert io.expire_folded(spark, path, grace_seconds=0) == 3
    assert {n for n, _ in fs.list_dirs(spark, path) if n.startswith("batch")} == {"batch_id=3"}
    assert io.read_fact(spark, path).count() == 12
    st.compact(spark, path, str(tmp_path / "snapshot2"))
    assert io.read_fact(spark, path).count() == 12


def test_logs_are_written_out(spark, tmp_path):
    log = st.RowLog("batch_id long, event_type string, count long", str(tmp_path / "log"), flush_every=4)
    for batch in range(5):
        log.add(spark, [(batch, "watch", 3), (batch, "other", 1)])
        assert len(log.rows) < 4
    assert log.frame(spark).count() == 10 and log.seen == 10


def test_batch_log_has_every_kind_once(spark, tmp_path):
    lines = [json.dumps(json.loads(_event(i, "watch")) | {"event_type": kind})
             for i, kind in enumerate(["watch", "search", "watch", "pause", "like", "like", None])]
    batch = ev.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    want = [(4, "like", 2), (4, "pause", 1), (4, "search", 1), (4, "watch", 2), (4, None, 1)]
    log = st.BatchLog(str(tmp_path / "log"), fold_at=3)
    paths = st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s"))
    for _ in range(2):  # the second one is a retry
        st.batch_writer(lambda: _movies(spark), paths, log=log)(batch, 4)
        assert rows(log.frame(spark)) == want
    for n in range(5, 9):  # folded on the way, and retries of folded batches are refused too
        assert log.append(n, ev.kind_counts(batch)) and not log.append(n, ev.kind_counts(batch))
    assert log.frame(spark).count() == 25 and not log.append(4, ev.kind_counts(batch))


def test_unknown_kinds_are_one_row(spark):
    events = spark.createDataFrame([("watch",), ("search",), ("a",), ("b",), (None,)], "event_type string")
    assert rows(ev.event_stats(events)) == [("other", 3), ("search", 1), ("watch", 1)]


def test_live_genres_follow_the_dimension(spark):
    counts = spark.createDataFrame([("1", 4), ("2", 5), (None, 1)], "movie_id string, count long")
    before = spark.createDataFrame([(1, "Drama")], "movie_id long, genre_primary string")
    after = spark.createDataFrame([(1, "Action"), (2, "Action")], "movie_id long, genre_primary string")
    assert rows(st.genre_totals(counts, before)) == rows(spark.createDataFrame([("Drama", 4), (None, 6)], "g string, c long"))
    assert rows(st.genre_totals(counts, after)) == rows(spark.createDataFrame([("Action", 9), (None, 1)], "g string, c long"))


def test_live_genre_deltas_touch_only_their_movies(spark, tmp_path):
    from reelpulse.sources import manifest

    dim, deltas, totals = (str(tmp_path / x) for x in ("dim", "deltas", "totals"))
    io.publish_report(_movies(spark), dim)
    read = []

    def movies():
        read.append(1)
        return io.load_table(spark, dim)

    write = st.genre_writer(movies, deltas, totals, lambda: manifest.latest(spark, dim).version, fold_at=4)

    def batch(*ids):
        return spark.createDataFrame([(i,) for i in ids], "movie_id string")

    def now():
        return dict(rows(io.load_report(spark, totals, "genre_primary string, count long")))

    write(batch(*(str(i) for i in range(200)), "0"), 0)
    assert now() == {"Drama": 3, "Comedy": 1, None: 197}
    write(batch("1", "1", None), 1)
    # the second batch committed two rows, however many movies were ever seen
    assert rows(io.read_batches(spark, deltas, "movie_id string, count long", only=1)) == [("1", 2), (None, 1)]
    assert now() == {"Drama": 3, "Comedy": 3, None: 198}
    write(batch("1", "1", None), 1)  # a retry
    assert now() == {"Drama": 3, "Comedy": 3, None: 198} and len(read) == 2
    # a new version of the dimension moves views counted before
    io.publish_report(spark.createDataFrame([(0, 1.0, "Action"), (7, 1.0, "Action")],
                                            "movie_id long, duration_minutes double, genre_primary string"), dim)
    write(batch("2"), 2)
    assert now() == {"Action": 3, None: 202}
    for n in range(3, 9):
        write(batch("7"), n)
    assert now() == {"Action": 9, None: 202}
    assert len(manifest.latest(spark, deltas).batches) < 4  # folded into one row per movie
    write(batch("7"), 5)  # a late replay of a folded batch
    assert now() == {"Action": 9, None: 202}


def test_hot_and_null_keys_are_spread_without_adaptive_execution(spark):
    from reelpulse.operators.joins import hot_keys, spread_lookup

    n = 60_000
    facts = spark.range(n, numPartitions=6).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("m"), (F.col("id") % 3001).cast("string"))).alias("movie_id"))
    dim = spark.range(3001).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("movie_id"), F.col("id").alias("_length"))
    dim = dim.unionByName(spark.createDataFrame([("hot", 7)], "movie_id string, _length long"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = spread_lookup(facts, dim, "movie_id")
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        plain = facts.join(dim, "movie_id", "left").select("row", "movie_id", "_length")
        assert out.select("row", "movie_id", "_length").exceptAll(plain).count() == 0 and out.count() == n
        parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * 16
        assert hot_keys(facts.filter("movie_id is not null"), "movie_id").count() <= parts
        assert spread_lookup(facts.limit(0), dim, "movie_id").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rejects_are_counted_per_batch(spark, tmp_path):
    good = json.loads(_event(1, "watch"))
    lines = [json.dumps(good), "not json", "", "[1]", "17", "{}", json.dumps(good | {"user_id": None}),
             json.dumps(good | {"watch_duration_minutes": "long", "user_rating": "x"}),
             json.dumps(good | {"user_rating": 2.5}), json.dumps(good | {"device_type": 4}),
             json.dumps(good | {"user_id": None, "user_rating": "x"}), '{"user_id": "u", "event_type"']
    landing = _land(tmp_path, [(0, lines[:6]), (1, lines[6:])])
    listener = st.MetricsListener(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(listener)
    paths = st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s"), checkpoint=str(tmp_path / "chk"))
    try:
        q = st.start_ingest(st.refine(st.event_stream(spark, "text", landing, max_per_trigger=1)), lambda: _movies(spark), paths,
                            trigger={"availableNow": True})
        q.awaitTermination()
        import time
        for _ in range(100):
            if listener.log.seen >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    got = {r["batch_id"]: tuple(r[c] for c in ("records", "malformed", "null_user", "mistyped"))
           for r in listener.to_frame(spark).collect()}
    assert got == {0: (6, 4, 1, 0), 1: (6, 1, 2, 4)}
    # a row with a mistyped field stays, with that field null
    kept = io.read_fact(spark, paths.watch, "watch")
    assert kept.count() == 4 and kept.filter("user_rating is null").count() == 2


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    import pytest

    from reelpulse import session

    monkeypatch.setattr(session, "_configured_checkpoint_dir", lambda s: None)
    monkeypatch.setattr(session, "_is_local", lambda s: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(spark, "x")


def test_night_window_inside_a_day(spark):
    from reelpulse.operators.reports import night_filter

    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    assert [r[0] for r in night_filter(hours, (1, 5)).orderBy("hour").collect()] == [1, 2, 3, 4, 5]
    assert night_filter(hours).count() == 7


def test_second_checkpoint_cannot_take_over_a_fact_path(spark, tmp_path):
    import pytest

    landing = _land(tmp_path, [(0, [_event(i, "watch") for i in range(4)])])
    paths = st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s"), checkpoint=str(tmp_path / "chk1"))
    values = st.refine(st.event_stream(spark, "text", landing))
    st.start_ingest(values, lambda: _movies(spark), paths, trigger={"availableNow": True}).awaitTermination()
    again = st.start_ingest(values, lambda: _movies(spark), paths, trigger={"availableNow": True})   # same owner
    again.awaitTermination()
    other = st.IngestPaths(watch=paths.watch, search=paths.search, checkpoint=str(tmp_path / "chk2"))
    with pytest.raises(st.OwnershipError):
        st.start_ingest(values, lambda: _movies(spark), other, trigger={"availableNow": True})
    assert io.read_fact(spark, paths.watch, "watch").count() == 4


def test_late_event_lands_in_its_event_hour(spark, tmp_path):
    late = json.loads(_event(1, "watch"))
    late["current_timestamp"] = "2023-12-25 03:15:00"          # a week behind the others
    landing = _land(tmp_path, [(0, [_event(2, "watch"), json.dumps(late)])])
    paths = st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s"), checkpoint=str(tmp_path / "chk"))
    st.start_ingest(st.refine(st.event_stream(spark, "text", landing)), lambda: _movies(spark), paths,
                    trigger={"availableNow": True}).awaitTermination()
    keys = {r["date_key"] for r in io.read_fact(spark, paths.watch, "watch").select("date_key").collect()}
    assert "2023122503" in keys and len(keys) == 2               # nothing dropped, no watermark


def test_compaction_low_water_mark(spark, tmp_path):
    paths = st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s"), checkpoint=str(tmp_path / "chk"))
    write = st.batch_writer(lambda: _movies(spark), paths)

    def batch(lo, hi):
        return ev.parse_events(spark.createDataFrame([(_event(i, "watch"),) for i in range(lo, hi)], "value string"))

    write(batch(0, 5), 0)
    write(batch(5, 9), 1)
    st.compact(spark, paths.watch, str(tmp_path / "snap1"))
    assert io.compaction_mark(spark, paths.watch) == (1, str(tmp_path / "snap1"))
    ids = lambda: sorted(r["session_id"] for r in io.read_fact(spark, paths.watch, "watch").collect())
    assert ids() == sorted(f"s{i}" for i in range(9))
    write(batch(100, 103), 0)                       # late replay of folded batch 0: skipped
    assert ids() == sorted(f"s{i}" for i in range(9))
    write(batch(9, 12), 2)                          # a new batch after the mark
    assert ids() == sorted(f"s{i}" for i in range(12))
    st.compact(spark, paths.watch, str(tmp_path / "snap2"))
    assert io.compaction_mark(spark, paths.watch)[0] == 2
    assert ids() == sorted(f"s{i}" for i in range(12))


def test_live_counts_since_cut_off(spark):
    events = ev.parse_events(spark.createDataFrame([(_event(i, "watch"),) for i in range(6)], "value string"))
    all_rows = dict(rows(st.live_device_counts(events)))
    later = dict(rows(st.live_device_counts(events, since="2024-01-02 00:00:00")))
    expected = events.filter(F.col("ts") >= "2024-01-02 00:00:00").count()
    assert sum(later.values()) == expected < sum(all_rows.values())


def test_hot_keys_are_joined_as_numbers(spark):
    from reelpulse.operators.joins import hot_keys
    from reelpulse.sources.io import key_buckets, spread_hot_keys

    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit("hot"))
                                  .otherwise(F.col("id").cast("string")).alias("k"), "id")
    assert dict(hot_keys(df, "k").dtypes)["_hot"] == "bigint"
    buckets = key_buckets(df, "k", 500).persist()
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buckets.count()
        out = spread_hot_keys(df, "k", 500, buckets=buckets)
        assert "HashedRelationBroadcastMode(List(input[0, bigint" in plan_text(out, "extended")
        assert rows(out) == rows(df)                                # null keys and hot ones, each row once
        for hot in ("k is null", "k = 'hot'"):
            per_task = [r["count"] for r in out.filter(hot).groupBy(F.spark_partition_id()).count().collect()]
            assert len(per_task) > 1 and max(per_task) < 3000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        buckets.unpersist()


def test_a_batch_has_tasks_by_its_rows(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(io, "append_fact", lambda df, path, batch_id, *a: seen.append((df.rdd.getNumPartitions(), rows(df))))
    batch = ev.parse_events(spark.createDataFrame(
        [(_event(i, "watch" if i % 3 else "search"),) for i in range(60)], "value string"))
    confs = {"spark.sql.shuffle.partitions": "96", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        st.batch_writer(lambda: _movies(spark), st.IngestPaths(watch=str(tmp_path / "w"), search=str(tmp_path / "s")))(batch, 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    cores = spark.sparkContext.defaultParallelism
    assert [n <= cores for n, _ in seen] == [True, True]
    assert seen[0][1] == rows(ev.watch_facts(ev.route(batch, "watch"), _movies(spark)))
    assert st.tasks_for(spark, 0) == cores and st.tasks_for(spark, 1000 * st.ROWS_PER_TASK + 1) == 1001
