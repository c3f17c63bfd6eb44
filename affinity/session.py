"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for correctness or scale, applied only where unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Only read when a session starts.
START_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_spark(app: str = "affinity", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return the active session or build one (local runs and tests).

    An active session keeps its own values: a default is only set where the
    session's configuration does not name the key."""
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        for k, v in {**START_CONF, **(conf or {})}.items():
            builder = builder.config(k, v)
        if shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        active = builder.getOrCreate()
    named = dict(active.sparkContext.getConf().getAll())
    for k, v in DEFAULT_CONF.items():
        if k not in named:
            active.conf.set(k, v)
    ensure_checkpoint_dir(active)
    return active


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: ``spark.checkpoint.dir`` if the
    cluster sets it; a scratch folder only for a local master.

    Returns the configured base folder; the context's checkpoint directory is
    only set when none exists yet (setting it again would nest a new folder).
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if base:
        if not current:
            sc.setCheckpointDir(base)
        return base
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: stages need a folder that the driver and "
                           "all executors share")
    path = tempfile.mkdtemp(prefix="affinity-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def owned_path(spark: SparkSession, folder: str, name: str) -> str:
    """A fresh folder under the checkpoint directory that is deleted when the
    application ends (also after a failure that reaches the shutdown hook)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{folder}/{name}-{uuid.uuid4().hex[:12]}"
    p, fs = _hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return path


# Spark keeps the shuffle files of an action until the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the actions within are deleted as each of them ends."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the input only once
    (an RDD checkpoint recomputes an uncached input), survives executor loss
    (shared storage), and gives the planner real file statistics.  The folder
    belongs to the application and goes with it; ``release`` deletes it earlier.
    What the write shuffled is deleted when it ends: nothing reads it again.
    """
    if getattr(df, "_affinity_path", None):
        return df
    spark = df.sparkSession
    path = owned_path(spark, "affinity-stages", name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._affinity_path = path
    return out


def release(df) -> None:
    """Delete a materialised stage that nothing will read again."""
    path = getattr(df, "_affinity_path", None)
    if path:
        p, fs = _hadoop_path(df.sparkSession, path)
        fs.delete(p, True)
        fs.cancelDeleteOnExit(p)
        df._affinity_path = None
