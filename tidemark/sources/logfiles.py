"""Which redo log files hold a range of SCNs.  Manifests are tables; all are DataFrame queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def online(log: DataFrame, logfile: DataFrame) -> DataFrame:
    """One member for each online log: name, first, next (and sequence)."""
    return log.join(logfile, "group").groupBy("first", "next", "sequence").agg(F.min("member").alias("name"))


def covers(scn: int) -> Column:
    return (F.col("first") >= scn) | (F.col("next") > scn)


def needed(log: DataFrame, logfile: DataFrame, archived: DataFrame, scn: int) -> DataFrame:
    """Files with what comes from ``scn`` on, one for each range, by their first SCN."""
    named = archived.where("name IS NOT NULL").select("first", "next", "name")
    every = online(log, logfile).select("first", "next", "name").union(named).distinct().where(covers(scn))
    return every.groupBy("first", "next").agg(F.min("name").alias("name")).orderBy("first")


def new(log: DataFrame, logfile: DataFrame, archived: DataFrame, loaded: DataFrame, scn: int) -> DataFrame:
    """Needed files whose sequence is not loaded yet."""
    named = archived.where("name IS NOT NULL").select("first", "next", "sequence", "name")
    every = online(log, logfile).select("first", "next", "sequence", "name").union(named).distinct().where(covers(scn))
    fresh = every.join(loaded.select(F.col("log_id").alias("sequence")), "sequence", "left_anti")
    return fresh.groupBy("first", "next", "sequence").agg(F.min("name").alias("name")).orderBy("first")


def dictionary(archived: DataFrame) -> DataFrame:
    """Archived logs from the last one that begins a dictionary on."""
    begin = archived.where("dictionary_begin = 'YES'").agg(F.max("first").alias("begin"))
    return archived.where("name IS NOT NULL").join(F.broadcast(begin), F.col("first") >= F.col("begin")).drop("begin")


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Files of both, each name once (the second's wins), by name."""
    both = first.withColumn("rank", F.lit(1)).unionByName(second.withColumn("rank", F.lit(2)))
    cols = [c for c in first.columns if c != "name"]
    return both.groupBy("name").agg(*[F.max_by(c, "rank").alias(c) for c in cols]).orderBy("name")


def start_scn(files: DataFrame, scn: int) -> DataFrame:
    """One row: ``scn`` if a file begins at or before it, else 0."""
    return files.agg(F.when(F.max((F.col("first") <= scn).cast("int")) == 1, F.lit(scn)).otherwise(F.lit(0)).cast("long").alias("start_scn"))


def reusable(loaded: DataFrame, scn: int) -> DataFrame:
    """One row: whether a loaded file's closed range has the SCN, so that a session can go on."""
    return loaded.agg(F.coalesce(F.max(F.lit(scn).between(F.col("first"), F.col("next"))), F.lit(False)).alias("reusable"))
