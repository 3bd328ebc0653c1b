"""Spark session helpers.

Jobs read the cluster's configuration; the defaults below only apply when a key
is unset (local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Job-level settings for the feature jobs: the assembled table has ~600 columns,
# beyond the default 100-field limit of whole-stage code generation (Spark falls
# back to interpreted code by itself if a generated method grows too large).
JOB_DEFAULTS = {
    "spark.sql.codegen.maxFields": "1000",
}


NO_SHARED_FOLDER = "spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share"


def job_session(app_name: str) -> SparkSession:
    """Session for the batch jobs: the cluster's settings plus ``JOB_DEFAULTS``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in JOB_DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tillroll", driver_memory: str = "8g") -> SparkSession:
    """Session for tests and single-node benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in {**LOCAL_DEFAULTS, **JOB_DEFAULTS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system path set by the operator:
    executors cannot see each other's local folders, so an unset one is an error
    there.  Only a local session (tests, single node) gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError(NO_SHARED_FOLDER)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(NO_SHARED_FOLDER)
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def materialize(df, name: str = "materialized"):
    """Write ``df`` as Parquet below the shared checkpoint folder and continue from
    the written table.

    Used for intermediate aggregates that several branches of one plan read (so
    the expensive input is computed once) and to cut long lineages.  One job
    writes the table (an eager ``checkpoint()`` of an unpersisted frame would
    compute it twice); the files live on the shared checkpoint storage, so they
    survive executor loss.  Local checkpoints are not used.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def task_slots(spark: SparkSession) -> int:
    """Parallel task slots of the session (shuffle partitions under Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
