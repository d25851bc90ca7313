"""Session construction, shared scratch space and lineage cuts.

Cluster rules kept here in one place:

* the checkpoint / scratch root is read from ``spark.checkpoint.dir``; a
  private directory is created only for a ``local[...]`` master where the
  setting is unset (tests, laptops);
* lineage is cut with ``DataFrame.checkpoint()`` (reliable, survives executor
  loss), never with ``localCheckpoint()``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete reliable checkpoint files once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app: str = "tessera",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster leave ``master`` unset so spark-submit decides, and size
    ``shuffle_partitions`` to the data (roughly input bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        settings.setdefault("spark.driver.memory", "16g")
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, creating a private one only locally."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) visible to every executor"
        )
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Scratch paths handed out in this process and not released yet.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint root for intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    _SCRATCH.append(os.path.join(root, "scratch", f"{name}-{uuid.uuid4().hex[:12]}"))
    return _SCRATCH[-1]


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process wrote, wherever the checkpoint root
    lies; the number of tables. Call it when no result built on them is needed any more, at
    the end of a job or between the queries of a long session."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    released = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        released += bool(path.getFileSystem(conf).delete(path, True))
    return released


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _SCRATCH:
        _SCRATCH.remove(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so once the driver's
    collector meets what held them, and that may be long after they have filled the disks."""
    spark._jvm.java.lang.System.gc()


def cut_lineage(df: DataFrame, keep_partitioning: bool = False,
                path: str | None = None) -> DataFrame:
    """Materialise ``df`` on the shared checkpoint storage and continue from it.

    Default: write a parquet table under the checkpoint root and read it back
    (one job; survives executor loss; the read is column-pruned and filtered
    like any table). ``path`` names the table explicitly and overwrites it,
    for iterative jobs that alternate between two paths so their scratch
    space stays bounded. ``keep_partitioning=True`` uses a reliable
    ``checkpoint()`` instead, which remembers the frame's hash partitioning and
    order so later joins on the same key neither shuffle nor sort it again. An
    adaptive plan tells neither, so the frame's plan is not adaptive; it is
    evaluated once, as it is written.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not keep_partitioning:
        if path is None:
            path = scratch_path(spark, "cut")
            df.write.mode("errorifexists").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        # with the schema given, no job reads it from the files
        return spark.read.schema(df.schema).parquet(path)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # planned under this setting: a frame keeps the first plan that it was given
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def dealt(df: DataFrame, key: str, part_rows: int) -> DataFrame:
    """A written table, dealt by ``key`` to parts of about ``part_rows`` rows; as it is if it
    already is read in that many parts."""
    parts = -(-df.count() // part_rows)
    return df.repartition(parts, key) if parts > df.rdd.getNumPartitions() else df
