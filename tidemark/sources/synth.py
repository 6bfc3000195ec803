"""A deterministic redo log made from ``orders``, for queries and tests, and its pieces.

Each order is one change; blocks of 400 orders interleave 50 transactions of 8 changes.  A transaction ends one SCN after
its last change, in a rollback if its number leaves 1 on division by 3, and those of the last block stay open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import LOG

PIECE = 60


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        F.col("o_orderkey").alias("k"), F.expr("(o_orderkey div 400) * 50 + o_orderkey % 50").alias("x"), F.expr("o_orderkey div 400").alias("block"), F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("st"), F.expr("CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)").alias("cents"),
        F.expr("CASE WHEN o_orderkey % 7 = 0 THEN concat('it''s where ', o_orderpriority) WHEN o_orderkey % 7 = 1 THEN NULL ELSE o_orderpriority END").alias("prio"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("placed"),
    )


def _statement() -> Column:
    lit = lambda c: f"CASE WHEN {c} IS NULL THEN 'NULL' ELSE concat('''', replace({c}, '''', ''''''), '''') END"
    test = lambda c, v: f"CASE WHEN {v} IS NULL THEN '\"{c}\" IS NULL' ELSE concat('\"{c}\" = ', {lit(v)}) END"
    where = f"concat(' where \"ID\" = ''', k, ''' and ', {test('PRIO', 'prio')}, ' and \"PLACED\" = TIMESTAMP '' ', placed, '''')"
    table = "concat('\"', owner, '\".\"', tab, '\"')"
    return F.expr(f"""
        CASE WHEN k % 103 = 0 THEN concat('alter table ', {table}, ' move')
             WHEN k % 101 = 0 THEN concat('insert into ', {table}, '("ID") values (''', k, ''') -- temporary tables')
             WHEN st = 'O' THEN concat('insert into ', {table}, '("ID","CUST","CENTS","PRIO","PLACED") values (''', k, ''',''', cust, ''',''', cents, ''',', {lit('prio')}, ',TIMESTAMP '' ', placed, ''')')
             WHEN st = 'P' THEN concat('update ', {table}, ' set "CENTS" = ''', cents, ''', "CUST" = NULL', {where})
             ELSE concat('delete from ', {table}, {where}) END""")


def redo(spark: SparkSession, sf_dir: str, users: bool = True, ids: int | None = None) -> DataFrame:
    """The log.  ``users``: some terminators have null or internal users, so that they don't count.  ``ids``: so many transaction ids
    (50, as many as are open at once) are used again and again."""
    xid = F.concat(F.lit("T"), F.col("x") if ids is None else F.col("x") % ids)
    o = _orders(spark, sf_dir)
    last = o.agg(F.max("block").alias("last_block"))
    named = F.expr("CASE x % 41 WHEN 0 THEN NULL WHEN 1 THEN 'UNKNOWNX' WHEN 2 THEN 'KMINER' ELSE 'APP' END") if users else F.lit("APP")
    o = o.withColumn("owner", F.expr("CASE WHEN k % 17 = 0 THEN 'TMP' ELSE 'SALES' END")).withColumn("tab", F.expr("CASE WHEN k % 13 = 0 THEN 'ORDERS_HIST' ELSE 'ORDERS' END"))
    changes = o.select(
        F.expr("(k + 1) * 10").alias("seq"), F.expr("(k + 1) * 10").alias("scn"), F.timestamp_seconds(F.expr("1577836800 + k")).alias("timestamp"),
        F.expr("CASE st WHEN 'F' THEN 'DELETE' WHEN 'O' THEN 'INSERT' ELSE 'UPDATE' END").alias("operation"), F.expr("CASE st WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 3 END").alias("operation_code"),
        F.expr("CAST(k % 97 = 0 AS INT)").alias("rollback"), F.col("owner").alias("seg_owner"), F.col("tab").alias("table_name"), F.lit("APP").alias("username"),
        _statement().alias("sql_redo"), F.format_string("R%012d", "k").alias("row_id"), F.lit(0).alias("csf"), xid.alias("xid"),
        F.expr("CASE WHEN k % 89 = 0 THEN 2 ELSE 0 END").alias("status"),
    )
    ends = o.groupBy("x").agg(F.max("k").alias("k"), F.max("block").alias("block")).join(F.broadcast(last), F.col("block") < F.col("last_block"))
    ends = ends.select(
        F.expr("(k + 1) * 10 + 1").alias("seq"), F.expr("(k + 1) * 10 + 1").alias("scn"), F.timestamp_seconds(F.expr("1577836800 + k")).alias("timestamp"),
        F.expr("CASE WHEN x % 3 = 1 THEN 'ROLLBACK' ELSE 'COMMIT' END").alias("operation"), F.expr("CASE WHEN x % 3 = 1 THEN 36 ELSE 7 END").alias("operation_code"), F.lit(0).alias("rollback"),
        F.lit(None).cast("string").alias("seg_owner"), F.lit(None).cast("string").alias("table_name"), named.alias("username"), F.expr("CASE WHEN x % 3 = 1 THEN 'rollback' ELSE 'commit' END").alias("sql_redo"),
        F.lit("R0").alias("row_id"), F.lit(0).alias("csf"), xid.alias("xid"), F.lit(0).alias("status"),
    )
    out = changes.unionByName(ends)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in LOG])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """What SALES.``name`` holds of the orders, as a database gives it, with row_id and row_scn: an order is there from its change on."""
    o = _orders(spark, sf_dir).where(F.expr(f"k % 17 <> 0 AND (k % 13 = 0) = {name == 'ORDERS_HIST'}"))
    return o.select(F.col("k").alias("ID"), F.col("cust").alias("CUST"), F.col("cents").alias("CENTS"), F.col("prio").alias("PRIO"), F.col("placed").cast("timestamp_ntz").alias("PLACED"), F.format_string("R%012d", "k").alias("row_id"), F.expr("(k + 1) * 10").alias("row_scn"))


def split(log: DataFrame, piece: int = PIECE) -> DataFrame:
    """The log with its statements cut into rows of at most ``piece`` characters; ``seq`` is spread to make room."""
    n = F.greatest(F.ceil(F.length("sql_redo") / piece), F.lit(1)).cast("int")
    rows = log.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.withColumn("sql_redo", F.expr(f"substring(sql_redo, i * {piece} + 1, {piece})")).withColumn("csf", (F.col("i") < F.col("n") - 1).cast("int"))
    return rows.withColumn("seq", F.col("seq") * 1000 + F.col("i")).drop("n", "i")
