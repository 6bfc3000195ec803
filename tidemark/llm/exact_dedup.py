"""Exact deduplication with a heavy-hitter split.

A digest that many rows share would make one shuffle task as large as its group.  Misra-Gries summaries of each
partition, merged, name at most ``k`` candidates, among them every digest held by more than 2/k of the rows.  Their
winners are then computed exactly from all rows (minima that combine before the shuffle) and broadcast: at most ``k`` rows
of about 100 bytes.  Rows of these digests are decided where they are; only the others are shuffled by digest, so no
group that meets in one task has more than 2/k of the rows.

Defined results: a null text is the empty text; all empty and all-blank texts are equal.  Of equal texts the row with
the most code points stays, then the one with the smallest id (a null id counts as largest), then the one with the
smallest hash of the raw text.  Of rows repeated with the same id and raw text one stays, whichever.  An empty table gives none.
Other columns pass through ``dedup`` whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidemark.llm.common import cut, small_batches, table, text_key, without

#: Counters of a Misra-Gries summary, and most rows of the broadcast.
HITTERS = 1024


def with_digest(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the SHA-256 (32 bytes) of the text without ASCII white space, null as empty, added as ``name``."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(at).cast(pa.binary()).to_pylist()
            # bytes.split() cuts at exactly these six characters; UTF-8 has them in no longer sequence
            out = pa.array([hashlib.sha256(b"".join(x.split()) if x else b"").digest() for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, name])

    return df.mapInArrow(digest, StructType([*df.schema.fields, StructField(name, BinaryType())]))


def misra_gries(keys: Iterator[bytes], k: int) -> dict[bytes, int]:
    """At most ``k`` keys with counts that fall short of the truth by at most n / (k + 1)."""
    held: dict[bytes, int] = {}
    for x in keys:
        if x in held:
            held[x] += 1
        elif len(held) < k:
            held[x] = 1
        else:
            held = {y: n - 1 for y, n in held.items() if n > 1}
    return held


def frequent(df: DataFrame, key: str, k: int = HITTERS) -> DataFrame:
    """At most ``k`` values of the binary column ``key``, with every one that over 2/k of the rows hold."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = misra_gries((x for b in batches for x in b.column(0).to_pylist() if x is not None), k)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["key", "n"])

    merged = df.select(key).mapInArrow(summary, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # sums lose nothing, so the largest k keep the bound; keys of one counted row can't be among the frequent ones
    return merged.where("n > 1").orderBy(F.desc("n"), "key").limit(k).select(F.col("key").alias(key))


def decide(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = HITTERS) -> DataFrame:
    """Each row's fate: id, digest, n_chars, raw and size (which tell raw texts apart), keep_id, group_size, kept."""
    rows = with_digest(df.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", "digest")
    rows = rows.select("id", "digest", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), *text_key(F.col("text")))
    # the number of a row, fixed by the checkpoint, tells even repeated rows apart
    rows = cut(rows.withColumn("no", F.monotonically_increasing_id()))
    out = ["id", "digest", "n_chars", "raw", "size"]
    best = F.struct((-F.col("n_chars")).alias("less"), F.col("id").isNull().alias("none"), "id", "raw", "no")

    named = F.broadcast(frequent(rows, "digest", k))
    exact = rows.join(named, "digest", "left_semi").groupBy("digest").agg(F.count("*").alias("group_size"), F.min(best).alias("w"))
    hot = F.broadcast(cut(exact.select("digest", "group_size", F.col("w.id").alias("keep_id"), F.col("w.no").alias("win"))))
    split = rows.join(hot, "digest", "left")
    settled = split.where("win IS NOT NULL").select(*out, "keep_id", "group_size", (F.col("no") == F.col("win")).alias("kept"))
    group = Window.partitionBy("digest")
    order = group.orderBy("less", F.col("id").isNull(), "id", "raw", "no")
    rest = split.where("win IS NULL").drop("keep_id", "group_size").withColumn("less", -F.col("n_chars"))
    rest = rest.withColumn("row", F.row_number().over(order)).withColumn("keep_id", F.first("id").over(order)).withColumn("group_size", F.count("*").over(group))
    return settled.unionByName(rest.select(*out, "keep_id", "group_size", (F.col("row") == 1).alias("kept")))


def dedup(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = HITTERS) -> DataFrame:
    """The rows of ``df`` that stay, with its columns.  Fates are decided on narrow rows; see ``without`` for the texts."""
    fate = decide(df, id, text, k).where("group_size > 1").groupBy("id", "raw", "size").agg(F.max("kept").alias("one"), F.min("kept").alias("all"))
    return without(df, id, text, cut(fate.where("NOT all").drop("all")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fate = decide(table(spark, sf_dir, "documents"))
    return fate.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY n) AS group_size,
       row_number() OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) = 1 AS kept,
       sha256(n) AS text_sha256
FROM d
"""
