"""Tables that cut lineage, in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package (once for each application).

    The driver packs its own copy and Spark hands it to every executor, also to later ones."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.basename(package)
        into = tempfile.mkdtemp(prefix=f"{name}-")
        shutil.copytree(package, f"{into}/src/{name}", ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(f"{into}/{name}", "zip", f"{into}/src"))
        _shipped.add(sc.applicationId)


class Scratch:
    """A run's own folder. ``keep`` writes a table there and reads it back, so a lost executor costs
    no more than the step at work. ``finish`` writes the result and removes all the other tables;
    what is left goes when the session's JVM ends (Hadoop's delete-on-exit)."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
        self.path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.made: list[str] = []
        self.fs.deleteOnExit(self.path)

    def keep(self, df: DataFrame) -> DataFrame:
        at = f"{self.folder}/{len(self.made)}"
        self.made.append(at)
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def finish(self, df: DataFrame) -> DataFrame:
        out = self.keep(df)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for at in self.made[:-1]:
            self.fs.delete(path(at), True)
        return out
