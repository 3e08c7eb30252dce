"""Readers and writers by logical name.

Formats are parameters: Parquet by default; ``delta`` (lakehouse) or a
document-store connector when their jars are on the classpath.  Library
writes go through this module and ``streaming``; ``plans/catalog`` also
lands the test binding's inputs and stored tables under the shared
scratch area.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelpulse import schemas
from reelpulse.sources import fs, manifest


class SchemaLockError(ValueError):
    """An overwrite would change a locked table's schema."""


# Formats addressed by a path; anything else (a document-store connector)
# is addressed by a collection name and configured from Spark conf
# (connection URI, database), never from code.
FILE_FORMATS = {"parquet", "orc", "json", "csv", "text", "avro", "delta"}
#: Hours of a micro-batch that get a folder each; rows of older ones are late.
RECENT_HOURS = 24


def _is_missing_path(err: AnalysisException) -> bool:
    cond = None
    for attr in ("getCondition", "getErrorClass"):
        try:
            cond = getattr(err, attr)()
            break
        except Exception:
            continue
    return cond == "PATH_NOT_FOUND"


def path_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path).schema  # resolves the path only
        return True
    except AnalysisException as err:
        if _is_missing_path(err):
            return False
        raise


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a published table (any committed version) or a plain folder is there."""
    return bool(manifest.versions(spark, path)) or path_exists(spark, path, fmt)


# --- sources -------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False, multiline: bool = False) -> DataFrame:
    """Header CSV with an explicit schema (inference only on request)."""
    reader = spark.read.option("header", True).option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw landing read: header CSV, every column kept as text."""
    return spark.read.option("header", True).option("inferSchema", False).option("multiLine", multiline).csv(path)


def compaction_mark(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """``(high, snapshot)`` if the fact table at ``path`` has been compacted: the
    highest folded batch and the snapshot's folder."""
    state = manifest.latest(spark, path)
    if state is None or state.snapshot is None:
        return None
    return state.folded[-1][1], manifest.resolve(path, state.snapshot)


def read_fact(spark: SparkSession, path: str, kind: str = "watch", with_batch_id: bool = False,
              state: manifest.State | None = None) -> DataFrame:
    """A fact table with the hour key read back as text (partition discovery
    alone would infer an int - trap T1).

    The folders are those of one manifest version (``state``, by default the
    newest): the snapshot, and the batches that are not folded into it, each with
    its late rows.  A batch that is being written is in no version, and a folded
    one only in the snapshot, so a reader sees every committed row once.  A table
    without a manifest is read as a plain partitioned folder.
    """
    schema = schemas.WATCH_FACT if kind == "watch" else schemas.SEARCH_FACT
    with_batch = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType(), True)])
    cols = [f.name for f in with_batch.fields] if with_batch_id else [f.name for f in schema.fields]
    state = state or manifest.latest(spark, path)
    reader = spark.read.schema(with_batch)
    if state is None:
        return reader.parquet(path).select(*cols)
    frames = []
    if state.snapshot:
        frames.append(reader.parquet(manifest.resolve(path, state.snapshot)))
    # folders of one shape are read together: hourly, late, and from before manifests
    shapes: dict = {}
    for folder in (f for folders in state.batches.values() for f in folders):
        base = f"{path}/{manifest.LATE}" if folder.startswith(manifest.LATE) else path
        shapes.setdefault((base, "/attempt=" in folder), []).append(f"{path}/{folder}")
    for (base, _), folders in sorted(shapes.items()):
        frames.append(spark.read.schema(with_batch).option("basePath", base).parquet(*folders))
    if not frames:
        return spark.createDataFrame([], with_batch).select(*cols)
    out = frames[0].select(*cols)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*cols))
    return out


def expire_folded(spark: SparkSession, path: str, grace_seconds: float = manifest.GRACE_SECONDS) -> int:
    """Remove the folders of a fact table that no version within the grace period
    names (folded batches, replaced snapshots, abandoned attempts); returns how many."""
    return manifest.expire(spark, path, grace_seconds)


def read_layer(spark: SparkSession, root: str, layer: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{root}/{layer}/{name}")


def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest version of a published table, or a plain folder as it is."""
    state = manifest.latest(spark, path) if fmt != "delta" else None
    return spark.read.format(fmt).load(path if state is None else manifest.resolve(path, state.snapshot))


def load_report(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """A published report, minus any store-assigned ``_id``; a report that
    was never written reads as an empty frame with its schema (a
    ``StructType`` or DDL string).  Any other failure is raised.  For a
    connector format ``path`` names the collection."""
    try:
        if fmt in FILE_FORMATS:
            df = load_table(spark, path, fmt)
        else:
            df = spark.read.format(fmt).option("collection", path.rstrip("/").rsplit("/", 1)[-1]).load()
    except AnalysisException as err:
        if _is_missing_path(err) and not manifest.versions(spark, path):
            return spark.createDataFrame([], schema)
        raise
    if "_id" in df.columns:
        df = df.drop("_id")
    return df


# --- sinks ---------------------------------------------------------------

def write_layer(df: DataFrame, root: str, layer: str, name: str, fmt: str = "parquet",
                lock_schema: bool = False) -> str:
    """Overwrite ``root/layer/name``.  With ``lock_schema`` an existing
    table's schema must not change (Delta's ``overwriteSchema=false``;
    plain Parquet would silently accept the new schema, so we compare)."""
    path = f"{root}/{layer}/{name}"
    spark = df.sparkSession
    writer = df.write.format(fmt).mode("overwrite")
    if lock_schema:
        if fmt == "delta":
            writer = writer.option("overwriteSchema", "false")
        elif path_exists(spark, path, fmt):
            old = spark.read.format(fmt).load(path).schema
            if [(f.name, f.dataType) for f in old.fields] != [(f.name, f.dataType) for f in df.schema.fields]:
                raise SchemaLockError(f"schema of {layer}/{name} would change: {old.simpleString()} -> {df.schema.simpleString()}")
    writer.save(path)
    return path


def publish_report(df: DataFrame, path: str, fmt: str = "parquet", options: dict | None = None,
                   grace_seconds: float = 3600, note: dict | None = None) -> None:
    """Replace a published table (one action).

    A file table gets a new version folder, and a manifest version then names it:
    a reader finds the old table or the new one, never a missing, empty or half
    written one.  A replaced version stays for ``grace_seconds``, and as long as a
    reader has it leased (``manifest.reading``).  A connector collection (``path``
    is its name) and a Delta table are overwritten by their own means.
    """
    writer = df.write.format(fmt).options(**(options or {})).mode("overwrite")
    if fmt not in FILE_FORMATS:
        writer.option("collection", path.rstrip("/").rsplit("/", 1)[-1]).save()
        return
    if fmt == "delta":
        writer.save(path)
        return
    spark = df.sparkSession
    folder = manifest.new_folder("version=")
    writer.save(f"{path}/{folder}")
    manifest.commit(spark, path, lambda s: replace(s, snapshot=folder, note=note or {}))
    manifest.expire(spark, path, grace_seconds)


def save_dimension(df: DataFrame, path: str) -> None:
    publish_report(df, path)


def key_buckets(df: DataFrame, key: str, rows_per_task: int = 1_000_000) -> DataFrame:
    """One row per key value: how many salted buckets its rows need."""
    from pyspark.sql import functions as F

    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).select(
        F.col(key).alias("_key"),
        F.greatest(F.lit(1), F.ceil(F.col("_rows") / F.lit(rows_per_task))).cast("long").alias("_buckets"),
    )


def spread_hot_keys(df: DataFrame, key: str, rows_per_task: int = 1_000_000,
                    buckets: DataFrame | None = None) -> DataFrame:
    """Hash-cluster rows by ``key`` for a partitioned write, splitting hot
    keys: rows are counted per key and a key with more than
    ``rows_per_task`` rows is salted over that many buckets (tasks and
    files).  In a live stream most events of a batch share the current
    hour; without the salt one task would write nearly the whole batch.

    Only the hot keys' counts are joined, by the key's hash (keys that share one
    take the larger count; Spark keeps a broadcast table of numbers in 1 MB, one of
    texts in pages of up to 64 MB), without a hint, so Spark broadcasts them only
    while they are small.  Call it on a persisted frame (a micro-batch): the counts
    and the write read it twice.
    """
    from pyspark.sql import functions as F

    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    counts = buckets if buckets is not None else key_buckets(df, key, rows_per_task)
    hot = counts.filter("_buckets > 1").groupBy(F.xxhash64("_key").alias("_hash")).agg(F.max("_buckets").alias("_buckets"))
    salted = df.join(hot, F.xxhash64(df[key]) == hot["_hash"], "left")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.coalesce("_buckets", F.lit(1).cast("long")))
    # An explicit count: AQE must not fold a small batch into one task that
    # would then open every hour's file in turn.
    return salted.repartition(n, F.col(key), salt).drop("_hash", "_buckets")


def append_fact(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                rows_per_task: int = 1_000_000, recent_hours: int = RECENT_HOURS) -> bool:
    """Land one micro-batch and commit it to the table's manifest.

    Each attempt writes folders of its own, ``batch_id=N/attempt=X/date_key=H``;
    they count only when the manifest names them, and it takes a batch id once, so
    a replayed batch (at-least-once delivery, trap T10) or an attempt that was
    given up changes nothing; returns whether this attempt was committed.  Rows
    are clustered by hour key, hot hours spread over several tasks
    (``spread_hot_keys``).

    Only the batch's ``recent_hours`` newest hours get a folder each.  Rows of
    older hours (late events) go to one folder of the late lane, where the hour is
    a column; compaction folds them into their hours.  So a batch opens a bounded
    number of folders however far back its events reach.
    """
    from pyspark.sql import functions as F

    spark = df.sparkSession
    if manifest.ensure(spark, path).has(batch_id):
        return False
    # the per-hour counts are cached, so that their size is known to the join
    buckets = key_buckets(df, "date_key", rows_per_task).persist()
    try:
        newest = (buckets.filter(F.col("_key").isNotNull()).orderBy(F.desc("_key")).limit(recent_hours + 1)
                  .agg(F.count("_key"), F.min("_key")).first())
        first_late = newest[1] if newest[0] > recent_hours else None
        attempt = manifest.new_folder(f"batch_id={int(batch_id)}/attempt=")
        folders = [attempt]
        rows = spread_hot_keys(df, "date_key", rows_per_task, buckets=buckets)
        if first_late is not None:
            late = F.coalesce(F.col("date_key") <= first_late, F.lit(False))
            folders.append(f"{manifest.LATE}/{attempt}")
            df.filter(late).write.format(fmt).mode("overwrite").save(f"{path}/{folders[-1]}")
            rows = rows.filter(~late)
        rows.write.format(fmt).mode("overwrite").partitionBy("date_key").save(f"{path}/{attempt}")
    finally:
        buckets.unpersist()
    done = manifest.commit(spark, path, lambda s: None if s.has(batch_id) else s.with_batch(batch_id, folders))
    return done.batches.get(batch_id) == folders


def append_batch(df: DataFrame, path: str, batch_id: int) -> bool:
    """Commit the rows of a batch to a table that takes every batch id once; a
    retried batch is refused (False).  For logs and deltas, a few rows each."""
    spark = df.sparkSession
    if manifest.ensure(spark, path).has(batch_id):
        return False
    folder = manifest.new_folder(f"batch_id={int(batch_id)}/attempt=")
    df.write.parquet(f"{path}/{folder}")
    done = manifest.commit(spark, path, lambda s: None if s.has(batch_id) else s.with_batch(batch_id, [folder]))
    return done.batches.get(batch_id) == [folder]


def read_batches(spark: SparkSession, path: str, schema, state: manifest.State | None = None,
                 only: int | None = None) -> DataFrame:
    """Rows of all committed batches of such a table, or of one that is not folded."""
    state = state or manifest.latest(spark, path) or manifest.State()
    folders = [f for b, fs_ in state.batches.items() if only in (None, b) for f in fs_]
    if state.snapshot and only is None:
        folders.append(state.snapshot)
    if not folders:
        return spark.createDataFrame([], schema)
    # no partition columns: each folder is a table of its own
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(
        *(manifest.resolve(path, f) for f in folders))


def fold_batches(spark: SparkSession, path: str, schema, merge=None, at_least: int = 64,
                 grace_seconds: float = 3600) -> bool:
    """Rewrite such a table as one snapshot once it has ``at_least`` batches;
    ``merge`` may combine rows.  Batches that commit meanwhile stay beside it."""
    base = manifest.latest(spark, path)
    if base is None or len(base.batches) < at_least:
        return False
    rows = read_batches(spark, path, schema, base)
    folder = manifest.new_folder("_snapshots/")
    (merge(rows) if merge else rows).write.parquet(f"{path}/{folder}")

    def fold(now: manifest.State) -> manifest.State:
        if now.snapshot != base.snapshot:
            raise manifest.CommitConflict(f"{path} was folded meanwhile")
        return now.with_fold(folder, base.batches)

    manifest.commit(spark, path, fold)
    manifest.expire(spark, path, grace_seconds)
    return True


def write_events(events: DataFrame, target: str, key: str, fmt: str = "text",
                 options: dict | None = None) -> None:
    """Publish events as one JSON object each: lines of text files, or the
    ``value`` of a message topic (``fmt="kafka"``, broker and topic in
    ``options``) with the ``key`` column as its message key."""
    from pyspark.sql import functions as F

    from reelpulse.operators.events import to_json_value

    values = to_json_value(events.withColumn("_key", events[key].cast("string")), keep=("_key",))
    if fmt in FILE_FORMATS:
        values.select("value").write.format(fmt).options(**(options or {})).mode("append").save(target)
    else:
        (values.select(F.col("_key").alias("key"), "value")
         .write.format(fmt).options(**(options or {})).save())


def publish_events(parts: list[tuple[DataFrame, str]], target: str, run: str, fmt: str = "text",
                   options: dict | None = None) -> bool:
    """Publish [(events, message key column)] once per ``run``.

    Files are staged aside and moved to ``target/run=<run>`` in one step, so a run
    that failed half way has published nothing, and a rerun of a published one is
    refused (False).  A message topic has no such step: it takes the events at
    least once, each under its key.
    """
    spark = parts[0][0].sparkSession
    if fmt not in FILE_FORMATS:
        for events, key in parts:
            write_events(events, target, key, fmt, options)
        return True
    if fs.exists(spark, f"{target}/run={run}"):
        return False
    staged = f"{target}/{manifest.new_folder('_staging/')}"
    for events, key in parts:
        write_events(events, staged, key, fmt, options)
    done = fs.rename_new(spark, staged, f"{target}/run={run}")
    if not done:
        fs.remove(spark, staged)
    return done


def write_serving(df: DataFrame, target: str, batch_id: int, key: str, fmt: str = "parquet",
                  options: dict | None = None) -> None:
    """The serving copy of one micro-batch.  File formats use the same
    per-batch layout as the fact (a retry overwrites its own batch); a
    document-store connector upserts each row by its event key
    (``operationType=replace`` on ``idFieldList``), so a retried batch
    replaces documents instead of appending duplicates."""
    if fmt in FILE_FORMATS:
        append_fact(df, target, batch_id, fmt)
        return
    (
        df.write.format(fmt)
        .options(**(options or {}))
        .option("collection", target.rstrip("/").rsplit("/", 1)[-1])
        .option("operationType", "replace")
        .option("idFieldList", key)
        .mode("append")
        .save()
    )


def verify_written(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Re-read a written table and return its row count."""
    return load_table(spark, path, fmt).count()
