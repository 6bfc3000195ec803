"""Proportional stratified interleaving of documents into shards.

Within each source the rows are ranked in a seeded shuffled order (60 bits of an MD5 of seed, id and content).  The row of rank r
among n gets the fractional rank (r - 1/2) / n; sorted by it, every stretch of the whole order has the corpus's mixture,
and the order is cut into shards whose row counts differ by at most one (law ``rows``).

Neither ranking uses a window over a whole source or table.  Rows are dealt into ``BUCKETS`` equal ranges of the hash
(of the fraction), ranked inside their range, and raised by the number of rows in the ranges before, which comes from
counts that combine before the shuffle.  Only narrow rows are shuffled; texts are measured where they are read.

Defined results: a null source is a stratum of its own; a null text has no bytes; rows alike in id and content are
interchangeable; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import crc32_utf8, cut, table

#: Ranges that each ranking deals its rows into (a power of two); a range has about rows / BUCKETS rows.
BUCKETS = 4096
#: Bits of a draw.
DRAWN = 60


def ranked(df: DataFrame, by: list[str], bucket: str, order: list, name: str, total: str) -> DataFrame:
    """``df`` with the row number from 1 in the order (bucket, *order) within ``by``, and the number of rows there.

    One value of ``by`` may hold any share of the rows: windows see the counts of buckets, or the rows of one bucket.
    """
    counts = df.groupBy(*by, bucket).agg(F.count("*").alias("in_bucket"))
    every = Window.partitionBy(*by)
    before = every.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows
    counts = counts.select(*by, bucket, F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("before"), F.sum("in_bucket").over(every).alias(total))
    inner = Window.partitionBy(*by, bucket).orderBy(*order)
    return df.withColumn("inner_row", F.row_number().over(inner)).join(counts, [*by, bucket]).withColumn(name, F.col("before") + F.col("inner_row")).drop("before", "inner_row")


def interleave(df: DataFrame, shards: int, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """Each row's place: id, size (UTF-8 bytes and 1), text_crc32, shard from 0, slot (from 0, without gaps in a shard)."""
    crc = crc32_utf8(F.col(text))
    rows = df.select(
        F.col(id).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), crc.alias("text_crc32"),
    )
    seen = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"), F.col("size").cast("string"))
    rows = rows.withColumn("draw", F.conv(F.substring(F.md5(seen), 1, DRAWN // 4), 16, 10).cast("long"))
    order = ["draw", "id", "text_crc32", "size"]
    rows = rows.withColumn("bucket", F.shiftright("draw", DRAWN - (BUCKETS - 1).bit_length()))
    rows = cut(ranked(cut(rows), ["stratum"], "bucket", order, "rank", "n").drop("bucket"))
    rows = rows.withColumn("fraction", (F.col("rank") - 0.5) / F.col("n")).withColumn("all", F.lit(0))
    rows = rows.withColumn("bucket", F.floor(F.col("fraction") * BUCKETS))
    rows = ranked(rows, ["all"], "bucket", ["fraction", "stratum", *order], "place", "total").withColumn("place", F.col("place") - 1)
    # shard s holds the places from ceil(s * total / shards) on
    rows = rows.withColumn("shard", F.expr(f"cast((place * {shards}) div total as int)"))
    return rows.select("id", "size", "text_crc32", "shard", (F.col("place") - F.expr(f"(shard * total + {shards} - 1) div {shards}")).alias("slot"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 from its polynomial, byte by byte; then the same two rankings without ranges.
ORACLE = """
WITH RECURSIVE t AS (
  SELECT i, i AS c, 0 AS n FROM range(256) AS r(i) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n + 1 FROM t WHERE n < 8),
k AS (SELECT list(c ORDER BY i) AS tab FROM t WHERE n = 8),
h AS (SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
l AS (SELECT doc_id, source, size, [('0x' || b)::BIGINT for b in regexp_extract_all(h, '..')] AS bytes FROM h),
c AS (SELECT doc_id, coalesce('=' || source, '') AS stratum, size, xor(list_reduce(bytes, lambda a, x: xor(a // 256, tab[1 + (xor(a, x) & 255)]), 4294967295), 4294967295) AS crc FROM l, k),
d AS (SELECT *, ('0x' || substr(md5('17|' || doc_id || '|' || crc || '|' || size), 1, 15))::BIGINT AS draw FROM c),
f AS (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY draw, doc_id, crc, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS fraction FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, stratum, draw, doc_id, crc, size) - 1 AS place, count(*) OVER () AS total FROM f)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, (place * 8 // total)::INTEGER AS shard, place - (place * 8 // total * total + 7) // 8 AS slot, NULL::INTEGER AS grown_shard FROM p
"""
