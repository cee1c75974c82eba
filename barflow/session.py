"""Session helpers: a local session for tests, and the shared working folder of a cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's bound of the bytes in a batch that goes to Python.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_run_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Test tables are small: let a shuffle of some hundred kilobytes keep several tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Call sites per column expression cost more than the expressions in wide feature plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # HotSpot leaves methods over 8000 bytes uncompiled; Spark then does better with smaller pieces of
        # generated code than with one method per stage. Wide feature plans gain from it on a cluster as well.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def byte_size(spark: SparkSession, setting: str) -> int:
    """A setting in bytes, written with or without a unit (64m, 67108864b)."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def _run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate results.

    It lies under the shared folder, so every executor can read it and a lost executor loses nothing.
    Only a local master without that setting gets a folder of this machine. A local master's run folder
    goes when the process ends; on a cluster ``remove_run_folder`` ends it.
    """
    base, app, master = shared_folder(spark), spark.sparkContext.applicationId, spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    if not base and not local:
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: the master is {master}")
    if app not in _run_folders:
        _run_folders[app] = f"{base.rstrip('/')}/barflow/{app}" if base else tempfile.mkdtemp(prefix="barflow-")
        if local:
            atexit.register(shutil.rmtree, _run_folders[app].removeprefix("file://"), ignore_errors=True)
    return _run_folders[app]


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path for written intermediate results, in the run folder of the application."""
    return f"{_run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_run_folder(spark: SparkSession) -> None:
    """Delete what the application has staged, once all results that read it are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared work folder and read back.

    For plans that several branches or iterations read: the rows are computed once, and a lost
    executor costs no recomputation.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
