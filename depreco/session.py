"""Session construction, the shared checkpoint location and a run's own tables in it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "depreco", **conf) -> SparkSession:
    """A session. Partition counts and memory are set here only for a local master (tests and
    benchmarks); on a cluster they are the cluster's own settings."""
    b = SparkSession.builder.appName(app)
    settings = dict(DEFAULT_CONF)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
            settings["spark.driver.memory"] = os.environ.get("DEPRECO_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    A folder is only chosen here when the session names none, which happens in local
    tests; on a cluster the shared folder configured by the operator is used as is.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
        configured = tempfile.mkdtemp(prefix="depreco-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


class RunTables:
    """The tables one run writes, in a folder of its own under the checkpoint folder.

    ``keep`` materializes a frame as Parquet and reads it back. That cuts the lineage, survives
    the loss of an executor, and the table that is read carries its real size, from which the
    planner and adaptive execution choose the joins. ``close`` deletes the folder; a run that is
    never closed leaves it to the end of the session's JVM (Hadoop's delete-on-exit)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._path, self._fs = path, path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(path)
        self._fs.deleteOnExit(path)

    def keep(self, df: DataFrame) -> DataFrame:
        at = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def close(self) -> None:
        self._fs.delete(self._path, True)
