"""Working folders and the tables written there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def local_dir() -> str:
    """A temporary folder of this machine, removed at exit."""
    made = tempfile.mkdtemp(prefix="kindred-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return "file://" + made


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master may leave the setting out, and then has a temporary folder. On a cluster
    there is no folder to guess: that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = local_dir()
    return found.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


#: Whether Spark removes a query's shuffle files when it ends (from 4.1 on); else they stay until the driver's JVM collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end within leave no shuffle files; the session's own setting comes back after."""
    before = spark.conf.getAll.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Scratch:
    """Written tables under the shared folder: they cut lineage and outlive a lost executor.

    Tables that the caller drops go at once. The others are read by what a lazy result still has to
    do: the folder goes by ``clear``, else when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.marked = False

    def keep(self, name: str, frame: DataFrame) -> DataFrame:
        """Write ``frame`` and return it as read back. The shuffle files that this made go at once."""
        with shuffles_removed(self.spark):
            frame.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        if not self.marked:
            system, path = hadoop_path(self.spark, self.root)
            self.marked = system.deleteOnExit(path)
        return self.spark.read.schema(frame.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            system, path = hadoop_path(self.spark, f"{self.root}/{name}")
            system.delete(path, True)

    def clear(self) -> None:
        system, path = hadoop_path(self.spark, self.root)
        system.delete(path, True)
