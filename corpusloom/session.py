"""Session settings, and the folder that all executors share."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder, as in tests.
LOCAL_SHARED = os.path.join("/tmp", "corpusloom-shared")
#: Spark's setting for deleting a query's exchanges when the query ends; else they stay until the driver collects its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int = 8, shared: str = LOCAL_SHARED, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks in one JVM."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one is set only where none is named and driver and executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named or LOCAL_SHARED)
    return named or LOCAL_SHARED


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path of any file system that Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder and all in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    """Queries in it leave no exchanges on the executors' disks. Only for results that are written whole, since nothing reads
    the exchanges again then."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: its lineage ends here, and a lost executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    with _freeing(df.sparkSession):
        # The setting holds for plans that are made under it.
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read back. Unlike `cut`, exchanges over it can be reused in one plan."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    with _freeing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
