"""What several operators share: text measures, shared storage, and sessions' Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import delete, scratch, shared_dir

#: ASCII white space, [\x20\x09-\x0D], which bytes.split() uses too.
SPACES = " \t\n\x0b\x0c\r"
#: Rows and bytes of one Arrow batch; they bound a Python worker's memory (a row of more bytes is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read back from a reliable checkpoint, so that nothing above is run again."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows and BATCH_BYTES bytes, as whole texts may be long.

    The settings are read when a plan runs, so they stay in the session; smaller ones of the user's hold.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        held = spark.conf.get(key).rstrip("b")  # bytes are given as 1048576b, or in the unit that they were set in
        if not held.isdecimal() or not 0 < int(held) <= most:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, want: str) -> str:
    """``want``, with underscores in front until no column of df is called so (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want = "_" + want
    return want


def crc32_utf8(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as a table in the shared folder and read back.

    Unlike a checkpoint it has no known partitioning, so that a join shuffles both sides and skewed ones can be split.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            delete(df.sparkSession, path)


def text_key(text: Column) -> list[Column]:
    """What tells raw texts of one id apart, without sending them anywhere: a hash and the size (null is a text of its own)."""
    return [F.xxhash64(text).alias("raw"), F.coalesce(F.octet_length(text), F.lit(-1)).alias("size")]


def without(df: DataFrame, id: str, text: str, doomed: DataFrame) -> DataFrame:
    """``df`` without the rows whose (id, raw, size) is in ``doomed``; of those that are marked ``one`` there, one row stays.

    Whole rows are shuffled once at most (not at all if ``doomed`` is small), and by ids and texts, whatever the size of the
    groups that they were in.  Rows that repeat one of ``one`` are combined before their shuffle.
    """
    keys = ["id", "raw", "size"]
    # the row travels as one struct, so that its own columns' names can't clash with ours
    rows = df.select(F.struct("*").alias("row"), F.col(id).alias("id"), *text_key(F.col(text)))
    known = doomed.select(*[F.col(k).alias(f"of_{k}") for k in keys], "one")
    on = rows["id"].eqNullSafe(known["of_id"]) & (rows["raw"] == known["of_raw"]) & (rows["size"] == known["of_size"])
    rows = rows.join(known, on, "left")
    out = rows.where("one IS NULL").select("row.*")
    if not doomed.where("one").isEmpty():
        out = out.unionByName(rows.where("one").groupBy(*keys).agg(F.first("row").alias("row")).select("row.*"))
    return out
