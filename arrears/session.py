"""Session helpers: building a session, run folders and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, partitions: int | None = None,
                  app_name: str = "arrears") -> SparkSession:
    """Local/test session. On a cluster use the session the platform gives you."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    partitions = partitions or cpus
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.default.parallelism", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ARREARS_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CHECKPOINTS: dict = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (it is read, never changed: Spark rejects runtime changes to it). If it
    is unset, the application's ``setCheckpointDir`` folder is used; only when
    neither exists and the master is local (tests) one local folder per
    application is made; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not current:
        current = _LOCAL_CHECKPOINTS.get(sc.applicationId)
        if current is None:
            master = getattr(sc, "master", "local")
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="arrears-ckpt-")
            _LOCAL_CHECKPOINTS[sc.applicationId] = current
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts the lineage at a reliable copy, so a lost executor does not replay
    the shuffles and windows before it, and every later pass reads only the
    columns it needs.
    """
    spark = df.sparkSession
    path = os.path.join(run_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def compiled_methods(spark: SparkSession, key: str = "spark.sql.codegen.hugeMethodLimit", limit: int = 8000):
    """For jobs of many column expressions: generated methods above the JVM's own limit are never compiled,
    so such a stage runs operator by operator instead. The session's setting comes back at the end."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the checkpoint folder; all intermediate copies lie in it."""
    return os.path.join(ensure_checkpoint_dir(spark), f"run-{spark.sparkContext.applicationId}")


def clear_run_folder(spark: SparkSession) -> bool:
    """Delete this application's intermediate copies, at the end of a job; True when there were any.

    DataFrames that still read them cannot be used afterwards.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
