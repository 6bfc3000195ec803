"""Storage that the driver and all executors share, for tables that are read several times."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or, on one machine only, our own where it is unset."""
    sc = spark.sparkContext
    if at := sc.getConf().get("spark.checkpoint.dir"):
        return at.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which is deleted when the driver ends."""
    root = f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_clean, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


_ROOTS: set[str] = set()


def _clean(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session was stopped before
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Whether the files of a shuffle are deleted when its query ends; else they stay until the driver's memory is cleared of its plan.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> None:
    """What is written is read from there, so that no shuffle on the way is read again."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as Parquet and read back, so that nothing above runs again and each reader takes its columns only."""
    path = scratch(df.sparkSession, name)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``written``, and deleted at the end."""
    path = scratch(df.sparkSession, name)
    _write(df, path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none where it is not there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with a text, there as a whole or not at all; one that is there is replaced."""
    jvm = spark._jvm
    at, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"could not write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())  # one small file
