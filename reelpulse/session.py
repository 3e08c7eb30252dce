"""SparkSession defaults and the shared scratch location.

No global state: callers pass the session around.  Cluster settings
(shuffle partitions, memory, checkpoint dir) win over these defaults;
we only fill in what is unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Batch defaults: AQE re-plans joins and coalesces shuffle partitions at run
# time, skew-join splitting handles hot keys, UTC keeps hour buckets stable.
# They fill only what the cluster (or the caller) left unset.
BATCH_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}
# Static settings can only be given when the application starts.
STATIC_DEFAULTS = {"spark.ui.enabled": "false"}


def build_session(
    master: str | None = None,
    app: str = "reelpulse",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session.  Explicit arguments are applied as
    given; the batch defaults only where nothing is set yet."""
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        explicit["spark.driver.memory"] = driver_memory
    active = SparkSession.getActiveSession()
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if active is None:
        for k, v in {**STATIC_DEFAULTS, **explicit}.items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if active is not None:
        for k, v in explicit.items():
            if spark.conf.isModifiable(k):
                spark.conf.set(k, v)
    for k, v in BATCH_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_key(spark: SparkSession) -> str:
    """An id for this application (works without a SparkContext, e.g.
    under Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    for getter in (
        lambda: spark.conf.get("spark.checkpoint.dir", None),
        lambda: spark.sparkContext.getConf().get("spark.checkpoint.dir", None),
        lambda: spark.sparkContext.getCheckpointDir(),
    ):
        try:
            value = getter()
        except Exception:  # conf absent on this deployment
            value = None
        if value:
            return value
    return None


def scratch_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A directory path under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  With neither set, a ``local`` master gets a private temp
    dir, registered as the checkpoint dir so that later ``checkpoint()`` calls
    land in the same place; on a cluster that is an error, because executors
    would each write to their own disk.  Spark makes the directory on writing.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="reelpulse-")
        for setter in (lambda: spark.sparkContext.setCheckpointDir(base),
                       lambda: spark.conf.set("spark.checkpoint.dir", base)):
            try:
                setter()
            except Exception:  # static conf or no SparkContext on this client
                pass
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return f"{path}/{uuid.uuid4().hex}" if unique else path


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master == "local" or master.startswith("local[")
