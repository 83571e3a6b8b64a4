"""Where intermediate tables go."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which every executor reaches.

    Only where Spark runs in this one process (``local[...]``, as in tests) and nothing is set is a folder made
    here. On a cluster a missing setting is an error: each executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="emberline-")
    return _local_folders[app]


_scratch_folders: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one. It is deleted, with all it holds, when the driver's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch_folders:
        folder = f"{shared_folder(spark).rstrip('/')}/scratch-{app}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _scratch_folders[app] = folder
    return _scratch_folders[app]


def scratch_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, kind: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For tables that several later stages use: the work before is not repeated, losing an executor
    does not lose it, and the optimizer knows the real size.
    """
    path = scratch_path(df.sparkSession, kind)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the scratch tables that ``df`` reads, once nothing that reads them will run again."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession).rstrip("/").removeprefix("file://")
    for name in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if folder in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete shuffle files that nothing refers to any more.

    It does so when the driver's JVM collects what stood for them, which a job with a quiet driver would wait for
    until its disks are full.
    """
    gc.collect()
    spark._jvm.System.gc()
