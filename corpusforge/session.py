"""Sessions, table paths and shared storage for intermediate tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def local_session(cores: int = 8, partitions: int = 8, name: str = "corpusforge") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder. Only Spark's readers touch the path, so any store will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. A local one is used only where none is configured and all is on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = LOCAL_CHECKPOINTS
    return folder.rstrip("/")


_WRITTEN: list[str] = []
_HERE = threading.local()


#: Spark's setting by which a query's shuffle files go as soon as it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str) -> None:
    """Write a table as Parquet; the shuffle files that this took are deleted at the end."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write(df, path)
    _WRITTEN.append(path)
    if getattr(_HERE, "scratch", None) is not None:
        _HERE.scratch.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(df: DataFrame) -> None:
    """Delete an intermediate table that nothing reads any more."""
    path = getattr(df, "_written", None)
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        delete(df.sparkSession, path)


def discard_all(spark: SparkSession) -> None:
    """Delete every intermediate table of this process; for applications, once their results are written."""
    while _WRITTEN:
        delete(spark, _WRITTEN.pop())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread writes inside are deleted at the end; results must be written by then."""
    outer, _HERE.scratch = getattr(_HERE, "scratch", None), []
    try:
        yield
    finally:
        mine, _HERE.scratch = _HERE.scratch, outer
        for path in mine:
            if path in _WRITTEN:
                _WRITTEN.remove(path)
                delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table's folder, wherever it is."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
