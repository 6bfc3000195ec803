"""Redo log files as a data source, batch and stream, that opens only the files which hold the wanted SCNs.

A manifest, a small Parquet table (first, next, name), tells which file has the rows of [first, next); of several members of a
range that of the smallest name is read.  Each file that is needed is one partition, and its rows are filtered by SCN as they are read, so row groups
are left out, too.

    spark.dataSource.register(RedoLog)
    spark.read.format("redo_log").option("manifest", ...).load().where("scn >= 5000")
    spark.readStream.format("redo_log").option("manifest", ...).option("from_scn", 5000).load()

Filters on ``scn`` choose the files of a batch where spark.sql.python.filterPushdown.enabled is true; ``from_scn`` always does.  The offset of a stream
is the SCN up to which files are read: a batch has the files that came since the last one, and a restart opens new ones only.  A file whose ``next`` is null is
still written to, so a stream waits for it, while a batch reads it.  Where a file begins after the end of the one before, rows may be missing: ``gaps`` is
``fail`` (an error that names both SCNs), ``wait`` (a stream ends in front of the gap until it is filled), or ``skip`` (a warning).

Tasks read files with pyarrow, which knows local, HDFS, S3 and GCS paths; where only Spark's readers can open a path, ``read_needed`` gives the same
rows to batches.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from tidemark.schema import LOG
from tidemark.sources.logfiles import covers

_ARROW = {"long": pa.int64(), "string": pa.string(), "integer": pa.int32(), "timestamp": pa.timestamp("us", tz="UTC")}
ARROW = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in LOG])


@dataclass(frozen=True)
class LogFile(InputPartition):
    """A file and the SCNs [low, high) that are wanted of it (None: no bound)."""

    name: str
    first: int
    next: int | None
    low: int
    high: int | None


def _dataset(path: str) -> ds.Dataset:
    if "://" not in path:
        return ds.dataset(path, format="parquet")
    system, at = fs.FileSystem.from_uri(path)
    return ds.dataset(at, format="parquet", filesystem=system)


def manifest_of(path: str) -> list[tuple[int, int | None, str]]:
    """(first, next, name) of all ranges, by their first SCN; those that are still written to come last."""
    rows = _dataset(path).to_table(columns=["first", "next", "name"]).to_pylist()
    best: dict[tuple[int, int | None], str] = {}
    for r in rows:
        if r["name"] is not None:
            range_ = (r["first"], r["next"])
            best[range_] = min(r["name"], best.get(range_, r["name"]))
    return sorted(((*range_, name) for range_, name in best.items()), key=lambda x: (x[0], x[1] is None, x[1] or 0))


def read_file(part: LogFile | None) -> Iterator[pa.RecordBatch]:
    if part is None:  # no file is needed
        return
    wanted = pc.field("scn") >= part.low
    if part.high is not None:
        wanted = wanted & (pc.field("scn") < part.high)
    for batch in _dataset(part.name).to_batches(columns=ARROW.names, filter=wanted):
        if batch.num_rows:
            yield batch.cast(ARROW) if batch.schema != ARROW else batch


def check_gaps(files: list[tuple[int, int | None, str]], gaps: str, begin: int | None = None) -> list[tuple[int, int | None, str]]:
    """The files up to the first gap (all, if it is skipped): a file that begins after all before it, and after ``begin``, have ended."""
    at = begin
    for k, (first, next_, _) in enumerate(files):
        if at is not None and first > at:
            told = f"the log has a gap: SCN {at} was expected, the next file begins at {first}"
            if gaps == "fail":
                raise ValueError(told)
            if gaps == "wait":
                return files[:k]
            warnings.warn(told, stacklevel=2)
        at = max(next_, at or 0) if next_ is not None else at
    return files


class LogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.manifest, self.gaps = options["manifest"], options.get("gaps", "fail")
        self.low, self.high = int(options.get("from_scn", 0)), None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("scn",) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    stop = f.value + (not isinstance(f, LessThan))
                    self.high = stop if self.high is None else min(self.high, stop)
            yield f  # Spark evaluates all of them again; they only choose files and row groups

    def partitions(self) -> list[LogFile]:
        files = [x for x in manifest_of(self.manifest) if (x[1] is None or x[1] > self.low) and (self.high is None or x[0] < self.high)]
        return [LogFile(name, first, next_, self.low, self.high) for first, next_, name in check_gaps(files, "fail" if self.gaps == "wait" else self.gaps)]

    def read(self, partition: LogFile | None) -> Iterator[pa.RecordBatch]:
        return read_file(partition)


class LogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.manifest, self.gaps, self.begin = options["manifest"], options.get("gaps", "fail"), int(options.get("from_scn", 0))

    def _whole(self, low: int) -> list[tuple[int, int | None, str]]:
        return [x for x in manifest_of(self.manifest) if x[1] is not None and x[1] > low]

    def initialOffset(self) -> dict:
        return {"scn": self.begin}

    def latestOffset(self) -> dict:
        files = self._whole(self.begin)
        # the first file may begin later than asked for: what is before it was never kept
        return {"scn": max((x[1] for x in check_gaps(files, self.gaps, max(self.begin, files[0][0]))), default=self.begin) if files else self.begin}

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        low, high = start["scn"], end["scn"]
        return [LogFile(name, first, next_, low, high) for first, next_, name in self._whole(low) if first < high]

    def read(self, partition: LogFile | None) -> Iterator[pa.RecordBatch]:
        return read_file(partition)

    def commit(self, end: dict) -> None:
        pass


class RedoLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "redo_log"

    def schema(self) -> StructType:
        return LOG

    def reader(self, schema: StructType) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema: StructType) -> LogStream:
        return LogStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RedoLog)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)


def log(spark: SparkSession, manifest: str, from_scn: int = 0, gaps: str = "fail", stream: bool = False) -> DataFrame:
    """The rows of a manifest's files from an SCN on, as a batch or a stream."""
    register(spark)
    reader = spark.readStream if stream else spark.read
    return reader.format("redo_log").option("manifest", manifest).option("from_scn", from_scn).option("gaps", gaps).load()


def read_needed(spark: SparkSession, manifest: DataFrame, from_scn: int) -> DataFrame:
    """The rows from an SCN on of the files that hold them, by Spark's own reader; only their names go to the driver."""
    files = manifest.where("name IS NOT NULL").where(covers(from_scn) | F.col("next").isNull()).groupBy("first", "next").agg(F.min("name").alias("name"))
    names = [r["name"] for r in files.orderBy("first").select("name").collect()]
    rows = spark.read.schema(LOG).parquet(*names) if names else spark.createDataFrame([], LOG)
    return rows.where(F.col("scn") >= from_scn)
