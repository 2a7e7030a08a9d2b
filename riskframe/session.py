"""Session factory and shared scratch locations.

Scratch output (round-trip files, external tables, saved models, lineage
checkpoints) always goes under the checkpoint directory the cluster names in
``spark.checkpoint.dir``.  Only a local session without one (tests) gets a
private directory; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Scratch paths this process has handed out, for ``clear_scratch``.
_handed_out: list[str] = []


def build_session(
    master: str | None = "local[*]",
    app_name: str = "riskframe",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators assume.

    ``master=None`` leaves the master to the cluster launcher.  Shuffle width
    is left to AQE (it coalesces towards ``advisoryPartitionSizeInBytes``)
    unless ``shuffle_partitions`` is given, as local runs and tests do.  ANSI
    mode stays on (Spark 4 default); code columns are parsed with
    ``try_cast`` so malformed text becomes null instead of failing the job.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM.
        builder = builder.config("spark.driver.memory",
                                 os.environ.get("RISKFRAME_DRIVER_MEMORY", "16g"))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate output: the session's checkpoint dir.

    Reads the registered checkpoint dir or ``spark.checkpoint.dir``.  Where
    neither is set, a session whose executors are threads of the driver
    (``local[...]``, as in tests) gets a private folder; any other session
    raises, because executors would write to disks that nobody else sees.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="riskframe-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _handed_out.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared scratch root and read back, so that several
    consumers share one computation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete everything this process wrote through ``scratch_path``; returns how many
    places went.  Frames and external tables that still read them are lost with them,
    so call it when a job's results have been used or stored elsewhere."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _handed_out:
        path = files.Path(_handed_out.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone
