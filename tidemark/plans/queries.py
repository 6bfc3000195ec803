"""Queries of all operators over a log made from ``orders``, and DuckDB SQL that states the same results another way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.config import Config, Selector
from tidemark.functions import convert, names, types
from tidemark.operators import envelope, parse, reassembly, scan, transactions
from tidemark.plans import cdc, ledger
from tidemark.plans.cdc import CONNECTOR
from tidemark.schema import LOG
from tidemark.sources import catalog, logfiles, logsource, snapshot, synth

SALES = [Selector("SALES")]
ORDERS = [Selector("SALES", "ORDERS"), Selector("TMP", "ORDERS_HIST")]
SLIM = ["seq", "scn", "operation", "seg_owner", "table_name", "username", "xid"]

#: The synthetic log as SQL: o (orders), d (changes), t (terminators), redo (both), plain (both, with ordinary users).
REDO = r"""
WITH o AS (
  SELECT o_orderkey AS k, (o_orderkey // 400) * 50 + o_orderkey % 50 AS x, o_orderkey // 400 AS block, o_custkey AS cust, o_orderstatus AS st,
         CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS cents, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed,
         CASE WHEN o_orderkey % 7 = 0 THEN 'it''s where ' || o_orderpriority WHEN o_orderkey % 7 <> 1 THEN o_orderpriority END AS prio,
         CASE WHEN o_orderkey % 17 = 0 THEN 'TMP' ELSE 'SALES' END AS own, CASE WHEN o_orderkey % 13 = 0 THEN 'ORDERS_HIST' ELSE 'ORDERS' END AS tab
  FROM orders),
d AS (
  SELECT (k + 1) * 10 AS seq, (k + 1) * 10 AS scn, k, 'T' || x AS xid, CASE st WHEN 'F' THEN 'DELETE' WHEN 'O' THEN 'INSERT' ELSE 'UPDATE' END AS operation,
         k % 97 = 0 AS undone, own AS seg_owner, tab AS table_name, 'APP' AS username, CASE WHEN k % 89 = 0 THEN 2 ELSE 0 END AS status FROM o),
t AS (
  SELECT (max(k) + 1) * 10 + 1 AS seq, (max(k) + 1) * 10 + 1 AS scn, NULL AS k, 'T' || x AS xid, CASE WHEN x % 3 = 1 THEN 'ROLLBACK' ELSE 'COMMIT' END AS operation,
         false AS undone, NULL AS seg_owner, NULL AS table_name, CASE x % 41 WHEN 0 THEN NULL WHEN 1 THEN 'UNKNOWNX' WHEN 2 THEN 'KMINER' ELSE 'APP' END AS username, 0 AS status
  FROM o WHERE block < (SELECT max(block) FROM o) GROUP BY x),
redo AS (SELECT * FROM d UNION ALL SELECT * FROM t),
done AS (SELECT d.*, t.seq AS commit_seq, t.scn AS commit_scn FROM d JOIN t ON d.xid = t.xid WHERE t.operation = 'COMMIT')
"""
_SLIM = ", ".join(SLIM)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


# Filters


@query(f"{REDO} SELECT {_SLIM} FROM redo WHERE NOT undone AND ((operation IN ('COMMIT', 'ROLLBACK') AND scn >= 20000 AND username = 'APP') OR (operation NOT IN ('COMMIT', 'ROLLBACK') AND scn >= 5000 AND seg_owner = 'SALES'))")
def log_scan_filter(spark: SparkSession, sf: str) -> DataFrame:
    return scan.scan(synth.redo(spark, sf), SALES, 5000, 20000).select(*SLIM)


@query(f"{REDO} SELECT {_SLIM} FROM t WHERE username NOT IN ('UNKNOWNX', 'KMINER') AND scn >= 1000")
def control_rows(spark: SparkSession, sf: str) -> DataFrame:
    return scan.control_rows(synth.redo(spark, sf), 1000).select(*SLIM)


@query(f"{REDO} SELECT {_SLIM} FROM d WHERE k % 97 <> 0 AND scn >= 1000 AND seg_owner = 'SALES'")
def dml_rows(spark: SparkSession, sf: str) -> DataFrame:
    return scan.change_rows(synth.redo(spark, sf), SALES, 1000).select(*SLIM)


@query(f"{REDO} SELECT {_SLIM} FROM d WHERE k % 97 <> 0 AND (seg_owner, table_name) IN (('SALES', 'ORDERS'), ('TMP', 'ORDERS_HIST'))")
def table_whitelist(spark: SparkSession, sf: str) -> DataFrame:
    return scan.change_rows(synth.redo(spark, sf), ORDERS).select(*SLIM)


OFFSETS = [(5000, 7001, True), (5000, 7001, False), (8001, 8001, True), (8001, 8001, False)]


@query(f"""{REDO}, f(no, scn0, commit0, complete) AS (VALUES (0, 5000, 7001, true), (1, 5000, 7001, false), (2, 8001, 8001, true), (3, 8001, 8001, false)),
b AS (SELECT no, CASE WHEN complete THEN commit0 + 1 ELSE commit0 END AS c, CASE WHEN complete AND commit0 = scn0 THEN scn0 + 1 ELSE scn0 END AS s FROM f)
SELECT no, {_SLIM} FROM redo, b WHERE NOT undone AND ((operation IN ('COMMIT', 'ROLLBACK') AND scn >= c AND username = 'APP') OR (operation NOT IN ('COMMIT', 'ROLLBACK') AND scn >= s AND seg_owner = 'SALES'))""")
def resume_from_offset(spark: SparkSession, sf: str) -> DataFrame:
    log = synth.redo(spark, sf)
    parts = [scan.resume(log, SALES, *o).select(F.lit(i).alias("no"), *SLIM) for i, o in enumerate(OFFSETS)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(f"{REDO} SELECT {_SLIM} FROM redo WHERE NOT (k IS NOT NULL AND k % 101 = 0 AND k % 103 <> 0)")
def drop_temp_tables(spark: SparkSession, sf: str) -> DataFrame:
    return scan.drop_temporary(synth.redo(spark, sf)).select(*SLIM)


@query(f"{REDO} SELECT {_SLIM} FROM redo WHERE status <> 2")
def drop_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    return scan.drop_unreadable(synth.redo(spark, sf)).select(*SLIM)


@query(f"{REDO} SELECT {_SLIM} FROM d WHERE k % 103 <> 0")
def drop_unparsable(spark: SparkSession, sf: str) -> DataFrame:
    return parse.drop_unparsable(parse.spread(synth.redo(spark, sf).where("operation_code < 4"))).select(*SLIM)


@query(f"{REDO} SELECT min(scn) AS first_scn, min(scn) > 5005 AS gap FROM redo WHERE scn >= 5005")
def gap_check(spark: SparkSession, sf: str) -> DataFrame:
    return scan.gap(synth.redo(spark, sf), 5005)


# Transactions


@query(f"{REDO} SELECT {_SLIM}, commit_seq, commit_scn FROM done")
def committed_changes(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.committed_changes(synth.redo(spark, sf)).select(*SLIM, "commit_seq", "commit_scn")


@query(f"{REDO} SELECT seq, xid, row_number() OVER (ORDER BY commit_seq, seq) AS place FROM done")
def emission_order(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.emission_order(transactions.committed_changes(synth.redo(spark, sf))).select("seq", "xid", "place")


@query(f"{REDO} SELECT d.xid, t.operation AS end_operation, count(*) AS n FROM d JOIN t ON d.xid = t.xid GROUP BY ALL")
def txn_size(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.sizes(synth.redo(spark, sf)).select("xid", "end_operation", "n")


@query(f"{REDO} SELECT d.xid, arg_min(d.scn, d.seq) AS min_scn, max(t.scn) AS end_scn FROM d JOIN t ON d.xid = t.xid GROUP BY d.xid")
def txn_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.sizes(synth.redo(spark, sf)).select("xid", "min_scn", "end_scn")


@query(f"{REDO} SELECT arg_max(scn, seq) AS last_commit_scn FROM t WHERE operation = 'COMMIT'")
def last_commit_scn(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.last_commit_scn(synth.redo(spark, sf))


_OPEN = """, spans AS (SELECT d.xid, min(d.seq) AS a, arg_min(d.scn, d.seq) AS s, max(t.seq) AS z FROM d LEFT JOIN t ON d.xid = t.xid GROUP BY d.xid),
low AS (SELECT c.xid, c.seq AS commit_seq, (SELECT min(s) FROM spans WHERE spans.a < c.seq AND (spans.z IS NULL OR spans.z > c.seq)) AS low_scn FROM t AS c WHERE c.operation = 'COMMIT')"""


@query(f"{REDO}{_OPEN} SELECT xid, commit_seq, low_scn FROM low")
def low_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return transactions.low_watermark(synth.redo(spark, sf, users=False))


@query(f"""{REDO}{_OPEN}, r AS (SELECT *, row_number() OVER (PARTITION BY xid ORDER BY seq) AS ordinal, count(*) OVER (PARTITION BY xid) AS n FROM done)
SELECT r.seq, r.xid, r.ordinal, least(r.scn, low.low_scn) AS offset_scn, r.commit_scn AS offset_commit_scn, ceil(r.ordinal / 3.0) = ceil(r.n / 3.0) AS offset_complete FROM r JOIN low ON r.xid = low.xid""")
def record_offsets(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions.record_offsets(synth.redo(spark, sf, users=False), 3)
    return rows.select("seq", "xid", F.col("ordinal").cast("long").alias("ordinal"), F.col("offset.scn").alias("offset_scn"), F.col("offset.commitScn").alias("offset_commit_scn"), F.col("offset.isTransactionComplete").alias("offset_complete"))


# Statements

_WHERE = """' where "ID" = ''' || k || ''' and ' || CASE WHEN prio IS NULL THEN '"PRIO" IS NULL' ELSE '"PRIO" = ''' || replace(prio, '''', '''''') || '''' END || ' and "PLACED" = TIMESTAMP '' ' || placed || ''''"""
_SQL = f"""CASE WHEN k % 103 = 0 THEN 'alter table "' || own || '"."' || tab || '" move'
 WHEN k % 101 = 0 THEN 'insert into "' || own || '"."' || tab || '"("ID") values (''' || k || ''') -- temporary tables'
 WHEN st = 'O' THEN 'insert into "' || own || '"."' || tab || '"("ID","CUST","CENTS","PRIO","PLACED") values (''' || k || ''',''' || cust || ''',''' || cents || ''',' || CASE WHEN prio IS NULL THEN 'NULL' ELSE '''' || replace(prio, '''', '''''') || '''' END || ',TIMESTAMP '' ' || placed || ''')'
 WHEN st = 'P' THEN 'update "' || own || '"."' || tab || '" set "CENTS" = ''' || cents || ''', "CUST" = NULL' || {_WHERE} ELSE 'delete from "' || own || '"."' || tab || '"' || {_WHERE} END"""


@query(f"{REDO} SELECT (k + 1) * 10000 AS seq, 'T' || x AS xid, {_SQL} AS sql_redo FROM o")
def csf_reassembly(spark: SparkSession, sf: str) -> DataFrame:
    return reassembly.reassemble(synth.split(synth.redo(spark, sf))).where("operation_code < 4").select("seq", "xid", "sql_redo")


def _image(spark: SparkSession, sf: str, operation: str, image: str, columns: list[str]) -> DataFrame:
    rows = synth.redo(spark, sf).where(F.col("operation") == operation)
    rows = parse.drop_unparsable(parse.spread(rows if operation == "INSERT" else scan.drop_temporary(rows)))
    return rows.select("seq", F.size(image).alias("n_columns"), *[F.col(image)[c].alias(c.lower()) for c in columns])


_GOOD = "k % 103 <> 0 AND k % 101 <> 0"


@query(f"""{REDO} SELECT (k + 1) * 10 AS seq, 5 AS n_columns, k::VARCHAR AS id, cust::VARCHAR AS cust, cents::VARCHAR AS cents, prio, placed FROM o WHERE st = 'O' AND {_GOOD}
UNION ALL SELECT (k + 1) * 10, 1, k::VARCHAR, NULL, NULL, NULL, NULL FROM o WHERE st = 'O' AND k % 101 = 0 AND k % 103 <> 0""")
def parse_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _image(spark, sf, "INSERT", "after", ["ID", "CUST", "CENTS", "PRIO", "PLACED"])


@query(f"{REDO} SELECT (k + 1) * 10 AS seq, CASE WHEN prio IS NULL THEN 2 ELSE 3 END AS n_columns, k::VARCHAR AS id, prio, placed, cents::VARCHAR AS new_cents, true AS cust_set, NULL::VARCHAR AS new_cust FROM o WHERE st = 'P' AND {_GOOD}")
def parse_update(spark: SparkSession, sf: str) -> DataFrame:
    rows = parse.spread(scan.drop_temporary(synth.redo(spark, sf).where("operation = 'UPDATE'")))
    b, a = F.col("before"), F.col("after")
    return parse.drop_unparsable(rows).select(
        "seq", F.size("before").alias("n_columns"), b["ID"].alias("id"), b["PRIO"].alias("prio"), b["PLACED"].alias("placed"), a["CENTS"].alias("new_cents"),
        F.map_contains_key("after", "CUST").alias("cust_set"), a["CUST"].alias("new_cust"),
    )


@query(f"{REDO} SELECT (k + 1) * 10 AS seq, CASE WHEN prio IS NULL THEN 2 ELSE 3 END AS n_columns, k::VARCHAR AS id, prio, placed FROM o WHERE st = 'F' AND {_GOOD}")
def parse_delete(spark: SparkSession, sf: str) -> DataFrame:
    return _image(spark, sf, "DELETE", "before", ["ID", "PRIO", "PLACED"])


@query("""SELECT o_orderkey AS k, true AS parsed, 1 AS n_before, o_orderkey::VARCHAR AS id, '''x'' || ''y' || o_orderkey || '''' AS a, 'NVL(TO_CHAR(' || o_orderkey || '),''z, where'')' AS b,
o_orderkey || ' + 2' AS c, '-' || o_orderkey AS n FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, true, -1, NULL, 'UNISTR(''e4'') || UNISTR(''' || o_orderkey || ''')', 'f(g(h(' || o_orderkey || ', '')'')), 2)', '(1 + (' || o_orderkey || ' * 3))', NULL FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, o_orderkey % 2 = 0, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE -1 END, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR END, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 3 = 2""")
def parse_expressions(spark: SparkSession, sf: str) -> DataFrame:
    """Operators, calls in calls, arithmetic, comparisons other than =, repeated columns, and statements that break off."""
    texts = F.expr("""CASE WHEN k % 3 = 0 THEN concat('update "T" set "A" = ''x'' || ''y', k, ''', "B" = NVL(TO_CHAR(', k, '),''z, where''), "C" = ', k, ' + 2, "N" = -', k,
            ' where "ID" >= 5 and "ID" = ''0'' and "ID" = ', k, ' and "D" <> 3 and "E" between 1 and ', k)
        WHEN k % 3 = 1 THEN concat('insert into T(A, "B", C, "N") values (UNISTR(''e4'') || UNISTR(''', k, '''), f(g(h(', k, ', '')'')), 2), (1 + (', k, ' * 3)), NULL)')
        ELSE concat('delete from "T" where ("ID" = ', k, ' or "X" = ''a and b'')', if(k % 2 = 0, '', ' and "Y" = ''it')) END""")
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").alias("seq")).withColumn("sql_redo", texts)
    a = F.col("after")
    return parse.parse(parse.spread(rows)).select("k", "parsed", F.coalesce(F.size("before"), F.lit(-1)).alias("n_before"), F.col("before")["ID"].alias("id"), a["A"].alias("a"), a["B"].alias("b"), a["C"].alias("c"), a["N"].alias("n"))


@query("""SELECT o_orderkey AS k, true AS parsed, o_orderkey::VARCHAR AS id, repeat('(', 1 + o_orderkey % 30) || o_orderkey || repeat(')', 1 + o_orderkey % 30) AS a, 'f (' || o_orderkey || ', (2))' AS b FROM orders""")
def parse_brackets(spark: SparkSession, sf: str) -> DataFrame:
    """Brackets of up to 30 levels after gaps of any width, in assignments and around conditions."""
    gap = lambda n: F.expr(f"repeat(' ', CAST(k % {n} AS INT))")
    level = F.expr("CAST(1 + k % 30 AS INT)")
    lit, k = F.lit, F.col("k")
    sql = F.concat(
        lit('update "T" set "A" ='), gap(40), F.repeat(lit("("), level), k, F.repeat(lit(")"), level), gap(7), lit(', "B" = f '), gap(11), lit("("), k, lit(", "), gap(5), lit("(2)) where"), lit("\n"), gap(23),
        lit('(("ID" ='), gap(13), k, lit(") or exists (select 1 from \"U\" where \"ID\" = 0))"),
    )
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").alias("seq")).withColumn("sql_redo", sql)
    return parse.parse(parse.spread(rows)).select("k", "parsed", F.col("before")["ID"].alias("id"), F.col("after")["A"].alias("a"), F.col("after")["B"].alias("b"))


@query("""SELECT o_orderkey AS k, 'quote''s ' || o_orderpriority AS a, strftime(o_orderdate, '%Y-%m-%d') AS b, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS c, NULL::VARCHAR AS d, o_custkey::VARCHAR AS e, 'Name' AS f, 'HEXTORAW(''AB'')' AS g FROM orders""")
def decode_literal(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    day, second = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    quoted = lambda c, word="": F.concat(F.lit(word + "'"), c, F.lit("'"))
    d = parse.decode_literal
    return o.select(
        F.col("o_orderkey").alias("k"), d(quoted(F.concat(F.lit("quote''s "), "o_orderpriority"))).alias("a"), d(quoted(day, "DATE ")).alias("b"), d(quoted(second, "TIMESTAMP ")).alias("c"),
        d(F.lit("NULL")).alias("d"), d(F.col("o_custkey").cast("string")).alias("e"), d(F.lit('"Name"')).alias("f"), d(F.lit("HEXTORAW('AB')")).alias("g"),
    )


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS v FROM orders")
def null_literal(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("k"), convert.null_literal(F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'NULL' ELSE o_orderpriority END")).alias("v"))


@query(f"{REDO} SELECT (k + 1) * 10 AS seq, k::VARCHAR AS id, cents::VARCHAR AS cents, prio, placed, NULL::VARCHAR AS cust, CASE WHEN prio IS NULL THEN 4 ELSE 5 END AS n_columns FROM o WHERE st = 'P' AND {_GOOD}")
def after_image(spark: SparkSession, sf: str) -> DataFrame:
    rows = parse.drop_unparsable(parse.spread(scan.drop_temporary(synth.redo(spark, sf).where("operation = 'UPDATE'"))))
    rows = rows.withColumn("image", parse.after_image(F.col("operation_code"), F.col("before"), F.col("after")))
    return rows.select("seq", *[F.col("image")[c].alias(c.lower()) for c in ("ID", "CENTS", "PRIO", "PLACED", "CUST")], F.size("image").alias("n_columns"))


# Values


@query("""SELECT o_orderkey AS k, (o_orderkey % 100)::TINYINT AS a, (o_orderkey % 30000)::SMALLINT AS b, o_custkey::INTEGER AS c, o_orderkey AS d, (o_orderkey % 8)::FLOAT / 4 AS e, (o_orderkey % 1000)::DOUBLE / 8 AS f FROM orders""")
def cast_numeric(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    text = lambda e: F.expr(f"CAST({e} AS STRING)")
    n = convert.number
    return o.select(
        F.col("o_orderkey").alias("k"), n(text("o_orderkey % 100"), "tinyint").alias("a"), n(text("o_orderkey % 30000"), "smallint").alias("b"), n(text("o_custkey"), "int").alias("c"),
        n(text("o_orderkey"), "bigint").alias("d"), n(text("CAST((o_orderkey % 8) AS DOUBLE) / 4"), "float").alias("e"), n(text("CAST((o_orderkey % 1000) AS DOUBLE) / 8"), "double").alias("f"),
    )


@query("""SELECT o_orderkey AS k, o_orderkey * 100 + 25 AS hundredths, o_orderkey % 2 = 0 AS fits, o_orderkey || '.51665878295898400000' AS long, false AS long_in_10, o_orderkey % 4 = 0 AS wide, true AS zeros, o_orderkey * 10 AS scaled FROM orders""")
def cast_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """Values that fit, at 38 digits too, and values that would have to be rounded."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    exact = convert.decimal(F.concat("k", F.lit(".25")), 20, 2)
    perhaps = convert.decimal(F.concat("k", F.when(F.col("k") % 2 == 0, ".250").otherwise(".256")), 20, 2, strict=False)
    long = F.concat("k", F.lit(".516658782958984"))
    wide = F.concat(F.when(F.col("k") % 4 == 0, F.repeat(F.lit("9"), F.lit(28))).otherwise(F.repeat(F.lit("9"), F.lit(29))), F.lit(".5"))
    return o.select(
        "k", (exact * 100).cast("long").alias("hundredths"), perhaps.isNotNull().alias("fits"), convert.decimal(long, 38, types.FREE_SCALE).cast("string").alias("long"),
        convert.decimal(long, 38, 10, strict=False).isNotNull().alias("long_in_10"), convert.decimal(wide, 38, 10, strict=False).isNotNull().alias("wide"),
        (convert.decimal(F.concat("k", F.lit(".00000000000000000000000000000000000000000")), 38, 10) == F.col("k")).alias("zeros"),
        convert.decimal(F.concat("k", F.lit(".0E1")), 38, 0).cast("long").alias("scaled"),
    )


@query("SELECT event_id, (epoch_us(ts) // 1000) AS ms FROM events")
def ms_precision(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", F.unix_millis(convert.milliseconds(F.col("ts").cast("timestamp"))).alias("ms"))


def _events(spark: SparkSession, sf: str, pattern: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", F.date_format("ts", pattern).alias("text"))


@query("SELECT event_id, epoch_ms(date_trunc('day', ts)) // 86400000 AS day FROM events")
def parse_date(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, " yyyy-MM-dd HH:mm:ss").select("event_id", F.unix_date(convert.date(F.col("text"))).cast("long").alias("day"))


@query("SELECT event_id, epoch_us(ts AT TIME ZONE 'Europe/Berlin') // 1000 AS ms FROM events")
def parse_timestamp_tz(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, " yyyy-MM-dd HH:mm:ss.SSSSSS").select("event_id", F.unix_millis(convert.timestamp(F.col("text"), "Europe/Berlin")).alias("ms"))


@query("SELECT event_id, epoch_us(ts AT TIME ZONE 'US/Pacific') // 1000 AS ms FROM events")
def parse_timestamp_region(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.select("event_id", F.unix_millis(convert.timestamp_region(F.concat("text", F.lit(" US/Pacific PST")))).alias("ms"))


@query("SELECT event_id, epoch_us(ts) // 1000 - 19800000 AS ms FROM events")
def parse_timestamp_offset(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.select("event_id", F.unix_millis(convert.timestamp_offset(F.concat("text", F.lit("+05:30")))).alias("ms"))


@query("SELECT * FROM (VALUES (1, 'N'), (2, 'a b'), (3, 'it''s'), (4, ''), (5, NULL)) AS v(id, value)")
def default_string(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql("""SELECT * FROM VALUES (1, " 'N' "), (2, "a b"), (3, "'it's'"), (4, "''"), (5, NULL) AS v(id, text)""")
    return rows.select("id", convert.default_string(F.col("text")).alias("value"))


@query("SELECT * FROM (VALUES (1, 1), (2, 1), (3, NULL), (4, -7), (5, NULL)) AS v(id, value)")
def default_numeric(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql("SELECT * FROM VALUES (1, '1'), (2, '1 '), (3, '1+2'), (4, ' -7'), (5, NULL) AS v(id, text)")
    return rows.select("id", convert.default_number(F.col("text"), "int").alias("value"))


@query("SELECT * FROM (VALUES (1, 17633, NULL), (2, NULL, 1523494800000), (3, NULL, NULL), (4, NULL, NULL), (5, NULL, NULL)) AS v(id, day, ms)")
def default_temporal(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql("""SELECT * FROM VALUES (1, "DATE '2018-04-12'"), (2, "TIMESTAMP '2018-04-12 01:00:00'"), (3, "current_timestamp"), (4, "sysdate "), (5, NULL) AS v(id, text)""")
    day, ms = F.unix_date(convert.default_date(F.col("text"))).cast("long"), F.unix_millis(convert.default_timestamp(F.col("text"), "UTC"))
    return rows.select("id", F.when(F.col("id") == 1, day).alias("day"), F.when(F.col("id") != 1, ms).alias("ms"))


_TYPES = [
    ("NUMBER", 2, 0, "tinyint"), ("NUMBER", 3, 0, "smallint"), ("NUMBER", 4, 0, "smallint"), ("NUMBER", 5, 0, "int"), ("NUMBER", 10, 0, "bigint"), ("NUMBER", 20, 0, "decimal(20,0)"),
    ("NUMBER", None, None, "decimal(38,20)"), ("NUMBER", 0, 0, "decimal(38,20)"), ("NUMBER", 8, 2, "double"), ("NUMBER", 0, 3, "decimal(38,3)"), ("NUMBER", 30, 4, "decimal(30,4)"),
    ("NUMBER", 20, -3, "decimal(23,0)"), ("NUMBER", 2, -3, "tinyint"), ("DATE", None, None, "date"), ("TIMESTAMP(6)", None, 6, "timestamp"), ("TIMESTAMP(9) WITH TIME ZONE", None, 9, "timestamp"),
    ("TIMESTAMP(6) WITH LOCAL TIME ZONE", None, 6, "timestamp"), ("VARCHAR2", None, None, "string"), ("CHAR", None, None, "string"), ("NCHAR", None, None, "string"), ("NVARCHAR2", None, None, "string"),
    ("CLOB", None, None, "string"), ("BINARY_FLOAT", None, None, "float"), ("BINARY_DOUBLE", None, None, "double"), ("RAW", None, None, None), ("BLOB", None, None, None),
]


def _sql_rows(rows: list[tuple]) -> str:
    one = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join(f"({', '.join(map(one, r))})" for r in rows)


@query(f"SELECT * FROM (VALUES {_sql_rows([(i, t[3]) for i, t in enumerate(_TYPES)])}) AS v(id, type_name)")
def type_mapping(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.createDataFrame([(i, *t[:3]) for i, t in enumerate(_TYPES)], "id int, kind string, p int, s int")
    return rows.select("id", types.type_name(F.col("kind"), F.col("p"), types.scale_or_null(F.col("s"), F.col("p"))).alias("type_name"))


# Envelopes

_COLUMNS = [
    {"column_name": "ID", "data_type": "NUMBER", "data_precision": 12, "data_scale": 0, "nullable": "N", "column_id": 1},
    {"column_name": "CUST", "data_type": "NUMBER", "data_precision": 12, "data_scale": 0, "nullable": "Y", "column_id": 2},
    {"column_name": "CENTS", "data_type": "NUMBER", "data_precision": 14, "data_scale": 0, "nullable": "Y", "column_id": 3},
    {"column_name": "PRIO", "data_type": "VARCHAR2", "data_precision": None, "data_scale": None, "nullable": "Y", "column_id": 4},
    {"column_name": "PLACED", "data_type": "TIMESTAMP(6)", "data_precision": None, "data_scale": 6, "nullable": "Y", "column_id": 5},
]
VALUE, KEY = types.row_schemas(_COLUMNS, {"ID"})


def _records(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions.committed_changes(scan.drop_temporary(synth.redo(spark, sf)))
    return envelope.envelopes(parse.drop_unparsable(parse.spread(rows)), VALUE, KEY, "shop-db", CONNECTOR)


_LETTER = "CASE st WHEN 'F' THEN 'd' WHEN 'O' THEN 'i' ELSE 'u' END"
_DONE = f"{REDO}, c AS (SELECT o.*, done.seq, done.scn, done.xid, {_LETTER} AS op FROM (SELECT * FROM o WHERE {_GOOD}) AS o JOIN done ON o.k = done.k)"


@query(f"{_DONE} SELECT seq, k AS key_id FROM c")
def record_key(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).select("seq", F.col("key.ID").alias("key_id"))


@query(f"{_DONE} SELECT seq, '1.0' AS version, 'tidemark' AS connector, (1577836800 + k) * 1000 AS ms, xid AS tx_id, scn, own AS owner, tab AS table_name, 'APP' AS username FROM c")
def source_struct(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("value.source")
    return _records(spark, sf).select("seq", s["version"].alias("version"), s["connector"].alias("connector"), F.unix_millis(s["ts_ms"]).alias("ms"), s["txId"].alias("tx_id"), s["scn"].alias("scn"), s["schema"].alias("owner"), s["table"].alias("table_name"), s["user"].alias("username"))


@query(f"""{_DONE} SELECT seq, op, CASE WHEN op <> 'i' THEN k END AS old_id, CASE WHEN op <> 'i' THEN prio END AS old_prio, CASE WHEN op <> 'd' THEN k END AS new_id, CASE WHEN op = 'i' THEN cust END AS new_cust,
CASE WHEN op <> 'd' THEN cents END AS new_cents, CASE WHEN op <> 'd' THEN prio END AS new_prio, CASE WHEN op <> 'd' THEN epoch_ms(placed::TIMESTAMP) END AS new_placed FROM c""")
def change_envelope(spark: SparkSession, sf: str) -> DataFrame:
    b, a = F.col("value.before"), F.col("value.after")
    return _records(spark, sf).select("seq", "value.op", b["ID"].alias("old_id"), b["PRIO"].alias("old_prio"), a["ID"].alias("new_id"), a["CUST"].alias("new_cust"), a["CENTS"].alias("new_cents"), a["PRIO"].alias("new_prio"), F.unix_millis(a["PLACED"]).alias("new_placed"))


@query(f"{_DONE} SELECT seq, k AS key_id, 0 AS part, op FROM c UNION ALL SELECT seq, k, 1, NULL FROM c WHERE op = 'd'")
def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    return envelope.with_tombstones(_records(spark, sf)).select("seq", F.col("key.ID").alias("key_id"), "part", "value.op")


@query(f"{_DONE} SELECT seq, op FROM c WHERE NOT (op = 'i' AND prio IS NULL)")
def drop_invalid_envelope(spark: SparkSession, sf: str) -> DataFrame:
    strict, key = types.row_schemas([c | {"nullable": "N" if c["column_name"] == "PRIO" else c["nullable"]} for c in _COLUMNS], {"ID"})
    good, _ = envelope.split_invalid(_records(spark, sf), strict)
    return good.select("seq", "value.op")


@query("SELECT p_partkey AS id, 'shop-db.SALES.' || translate(p_name, ' $#/', '____') AS topic FROM part")
def topic_name(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("id"), names.topic_name("shop-db", F.lit("SALES"), F.col("p_name")).alias("topic"))


@query("SELECT * FROM (VALUES (1, true), (2, false), (3, false), (4, true), (5, false)) AS v(id, valid)")
def valid_table_name(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql("SELECT * FROM VALUES (1, 'SIT.TEST_TAB'), (2, 'SIT.MY-TAB'), (3, 'SIT.T$X'), (4, 'a/b@c'), (5, '') AS v(id, name)")
    return rows.select("id", names.valid_table_name(F.col("name")).alias("valid"))


# Snapshots of a page, and of several tables


def _table(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("CUST"), F.col("o_orderkey").alias("row_id"), ((F.col("o_orderkey") + 1) * 10).alias("row_scn"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey > 250 ORDER BY o_orderkey LIMIT 100")
def snapshot_page(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.page(_table(spark, sf), 100, 250).select(F.col("ID").alias("id"))


@query("""SELECT 0 AS table_no, o_orderkey AS id FROM orders UNION ALL SELECT 1, c_custkey FROM customer""")
def snapshot_multi_table(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("ID"), F.col("c_custkey").alias("row_id"), F.lit(10).cast("long").alias("row_scn"))
    both = snapshot.together([snapshot.read(_table(spark, sf), "SALES", "ORDERS", 9, CONNECTOR), snapshot.read(c, "SALES", "CUSTOMER", 9, CONNECTOR)])
    return both.select("table_no", F.get_json_object("after", "$.ID").cast("long").alias("id"))


# Snapshots as of SCNs of the log, so that they grow with their table


def _current(spark: SparkSession, sf: str) -> int:
    return snapshot.current_scn(synth.redo(spark, sf)).first()["current_scn"] or 0


_NOW = f"{REDO}, now AS (SELECT coalesce(max(scn), 0) AS scn0 FROM redo)"


@query(f"{_NOW} SELECT o_orderkey AS id, o_custkey AS cust FROM orders, now WHERE (o_orderkey + 1) * 10 <= scn0")
def snapshot_read(spark: SparkSession, sf: str) -> DataFrame:
    scn = _current(spark, sf)
    rows = snapshot.read(snapshot.as_of(_table(spark, sf), scn), "SALES", "ORDERS", scn, CONNECTOR)
    return rows.select(F.col("after.ID").alias("id"), F.col("after.CUST").alias("cust"))


@query(f"""{_NOW} SELECT 'r' AS op, true AS no_before, o_orderkey AS id, 0 AS ms, 'NOT AVAILABLE' AS tx_id, (o_orderkey + 1) * 10 AS scn, NULL::VARCHAR AS username, 'select' AS offset_type, scn0 AS offset_scn, o_orderkey::VARCHAR AS offset_row FROM orders, now WHERE (o_orderkey + 1) * 10 <= scn0""")
def snapshot_envelope(spark: SparkSession, sf: str) -> DataFrame:
    scn = _current(spark, sf)
    rows = snapshot.read(snapshot.as_of(_table(spark, sf), scn), "SALES", "ORDERS", scn, CONNECTOR)
    s = F.col("source")
    return rows.select(
        "op", F.col("before").isNull().alias("no_before"), F.col("after.ID").alias("id"), F.unix_millis(s["ts_ms"]).alias("ms"), s["txId"].alias("tx_id"), s["scn"].alias("scn"),
        s["user"].alias("username"), F.col("offset.type").alias("offset_type"), F.col("offset.scn").alias("offset_scn"), F.col("offset.rowId").alias("offset_row"),
    )


@query(f"{_NOW} SELECT o_orderkey AS id FROM orders, now WHERE o_orderkey > 250 AND (o_orderkey + 1) * 10 <= scn0")
def snapshot_resume(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.after(snapshot.as_of(_table(spark, sf), _current(spark, sf)), 250).select(F.col("ID").alias("id"))


@query(f"""{_NOW}, h AS (SELECT d.seq FROM d JOIN t ON d.xid = t.xid, now WHERE t.operation = 'COMMIT' AND d.scn >= scn0 // 2 AND t.scn >= scn0 // 2 AND t.username = 'APP' AND NOT d.undone AND d.seg_owner = 'SALES')
SELECT 'snapshot' AS part, (o_orderkey + 1) * 10 AS scn FROM orders, now WHERE (o_orderkey + 1) * 10 <= scn0 // 2 UNION ALL SELECT 'log', seq FROM h""")
def snapshot_then_cdc(spark: SparkSession, sf: str) -> DataFrame:
    scn = _current(spark, sf) // 2
    snap = snapshot.read(snapshot.as_of(_table(spark, sf), scn), "SALES", "ORDERS", scn, CONNECTOR)
    at = snapshot.handover({"type": "select", "scn": scn})
    log = transactions.committed_changes(scan.resume(synth.redo(spark, sf), SALES, at["scn"], at["commitScn"], at["isTransactionComplete"]))
    return snap.select(F.lit("snapshot").alias("part"), "source.scn").unionByName(log.select(F.lit("log").alias("part"), "scn"))


# Log files and catalog


def _manifests(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("n"))
    first, next_ = (F.col("n") * 1000).cast("long").alias("first"), ((F.col("n") + 1) * 1000).cast("long").alias("next")
    log = n.where("n >= 15").select(F.col("n").alias("group"), first, next_, F.col("n").alias("sequence"))
    member = n.where("n >= 15").withColumn("m", F.explode(F.array(F.lit("b"), F.lit("a")))).select(F.col("n").alias("group"), F.concat(F.lit("redo_"), "m", F.col("n")).alias("member"))
    archived = n.where("n < 18").select(first, next_, F.col("n").alias("sequence"), F.expr("CASE WHEN n % 5 <> 4 THEN concat('arch_', n) END").alias("name"), F.expr("CASE WHEN n % 6 = 1 THEN 'YES' ELSE 'NO' END").alias("dictionary_begin"))
    return log, member, archived, n.where("n % 3 = 0").select(F.col("n").alias("log_id"))


_FILES = """WITH f AS (SELECT n_nationkey * 1000 AS first, (n_nationkey + 1) * 1000 AS next, n_nationkey AS sequence, 'redo_a' || n_nationkey AS name FROM nation WHERE n_nationkey >= 15
UNION SELECT n_nationkey * 1000, (n_nationkey + 1) * 1000, n_nationkey, 'arch_' || n_nationkey FROM nation WHERE n_nationkey < 18 AND n_nationkey % 5 <> 4)"""


@query(f"{_FILES} SELECT first, next, min(name) AS name FROM f WHERE first >= 7500 OR 7500 < next GROUP BY first, next")
def log_files_needed(spark: SparkSession, sf: str) -> DataFrame:
    log, member, archived, _ = _manifests(spark, sf)
    return logfiles.needed(log, member, archived, 7500)


@query(f"{_FILES} SELECT first, next, sequence, min(name) AS name FROM f WHERE (first >= 7500 OR 7500 < next) AND sequence NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 3 = 0) GROUP BY first, next, sequence")
def log_files_new(spark: SparkSession, sf: str) -> DataFrame:
    return logfiles.new(*_manifests(spark, sf), 7500)


@query("SELECT n_nationkey AS sequence, 'arch_' || n_nationkey AS name FROM nation WHERE n_nationkey < 18 AND n_nationkey % 5 <> 4 AND n_nationkey >= 13")
def dictionary_logs(spark: SparkSession, sf: str) -> DataFrame:
    return logfiles.dictionary(_manifests(spark, sf)[2]).select("sequence", "name")


@query("SELECT 7500 AS start_scn, true AS reusable")
def log_session_start(spark: SparkSession, sf: str) -> DataFrame:
    log, member, archived, _ = _manifests(spark, sf)
    files = logfiles.merged(logfiles.dictionary(archived).select("name", "first", "next"), logfiles.needed(log, member, archived, 7500).select("name", "first", "next"))
    one = logfiles.start_scn(files, 7500).withColumn("one", F.lit(1))
    return one.join(logfiles.reusable(files, 9000).withColumn("one", F.lit(1)), "one").drop("one")


@query("""SELECT * FROM (VALUES ('SIT', 'TEST_TAB', 'ID', 'N', NULL, true, 'int'), ('SIT', 'TEST_TAB', 'STRING', 'Y', 'My Comment', false, 'string'), ('SIT', 'TEST_TAB', 'BIG_DECIMAL', 'Y', NULL, false, 'decimal(38,20)'),
('SIT', 'SECOND_TAB', 'ID', 'Y', NULL, false, 'int')) AS v(owner, table_name, column_name, nullable, comments, in_key, type_name)""")
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    cols = spark.sql("""SELECT * FROM VALUES ('SIT', 'TEST_TAB', 'ID', 'NUMBER', 8, 0, 'N'), ('SIT', 'TEST_TAB', 'STRING', 'VARCHAR2', NULL, NULL, 'Y'), ('SIT', 'TEST_TAB', 'BIG_DECIMAL', 'NUMBER', 0, 0, 'Y'),
        ('SIT', 'SECOND_TAB', 'ID', 'NUMBER', 8, 0, 'Y'), ('OTHER', 'T', 'ID', 'NUMBER', 8, 0, 'Y') AS v(owner, table_name, column_name, data_type, data_precision, data_scale, nullable)""")
    comments = spark.sql("SELECT * FROM VALUES ('SIT', 'TEST_TAB', 'STRING', 'My Comment'), ('SIT', 'TEST_TAB', 'GONE', 'x') AS v(owner, table_name, column_name, comments)")
    keys = spark.sql("SELECT * FROM VALUES ('SIT', 'TEST_TAB', 'ID') AS v(owner, table_name, column_name)")
    out = catalog.columns(cols, comments, keys, [Selector("SIT")])
    return out.select("owner", "table_name", "column_name", "nullable", "comments", "in_key", "type_name")


# Streaming


@query(f"{REDO} SELECT seq, xid, commit_seq, commit_scn FROM done")
def streaming_txn(spark: SparkSession, sf: str) -> DataFrame:
    """The log as four quarters, read one in each batch; open transactions are state between them."""
    from tidemark.streaming import transactions as streaming

    base = shared.scratch(spark, "stream")
    files = _write_in_parts(spark, synth.redo(spark, sf), f"{base}/log", range(4))
    streaming.use_rocksdb(spark)
    streaming.write(streaming.committed(streaming.log_files(spark, f"{base}/log", files)), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(streaming.OUT).parquet(f"{base}/out").select("seq", "xid", "commit_seq", "commit_scn")


#: Rows of a quarter's file, at least.
FILE_ROWS = 1_000_000


def _write_in_parts(spark: SparkSession, log: DataFrame, path: str, parts: range, rows: int = FILE_ROWS) -> int:
    """The quarters of a log that ``parts`` names, in the order of the log, and of how many files each quarter is: a batch takes so many.

    The log is made once and by all tasks, and a task writes about ``rows`` rows.  All quarters are of one number of files, none of them empty
    (a file has ``rows`` rows on average, so that some task deals rows to all of them), or else a batch would end within a quarter.
    """
    with shared.held(log, "redo") as log:
        step = (log.agg(F.max("seq").alias("m")).first()["m"] or 0) // 4 + 1
        sizes = [r["count"] for r in log.groupBy(F.expr(f"seq div {step}")).count().collect()]  # four rows
        files = max(min(sizes) // rows, 1) if len(sizes) == 4 else 1
        for i in parts:
            log.where((F.col("seq") >= step * i) & (F.col("seq") < step * (i + 1))).repartition(files).write.mode("append").parquet(path)
    return files


@query(f"{REDO} SELECT 'batch' AS part, {_SLIM} FROM redo, (SELECT max(scn) AS m FROM redo) WHERE scn >= m // 3 AND scn < 2 * m // 3 UNION ALL SELECT 'stream', {_SLIM} FROM redo, (SELECT max(scn) AS m FROM redo) WHERE scn >= m // 3")
def log_source_read(spark: SparkSession, sf: str) -> DataFrame:
    """A range of SCNs out of log files, of which only those that hold it are opened, and the log from an SCN on as a stream that ends and goes on as files come."""
    base, log = shared.scratch(spark, "source"), shared.written(synth.redo(spark, sf), "redo")
    last = snapshot.current_scn(log).first()["current_scn"] or 0
    step = last // 8 + 1
    for parts in (range(5), range(5, 8)):
        for i in parts:
            log.where((F.col("scn") >= step * i) & (F.col("scn") < step * (i + 1))).repartition(1).write.parquet(f"{base}/log/{i}")
        found = [(i * step, (i + 1) * step, f"{base}/log/{i}") for i in parts]
        spark.createDataFrame(found, "first long, next long, name string").coalesce(1).write.mode("append").parquet(f"{base}/manifest")
        rows = logsource.log(spark, f"{base}/manifest", last // 3, stream=True)
        rows.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    batch = logsource.log(spark, f"{base}/manifest").where((F.col("scn") >= last // 3) & (F.col("scn") < 2 * last // 3))
    return batch.select(F.lit("batch").alias("part"), *SLIM).unionByName(spark.read.schema(LOG).parquet(f"{base}/out").select(F.lit("stream").alias("part"), *SLIM))


# The whole job

_CATALOG = [c | {"owner": "SALES", "table_name": t, "in_key": c["column_name"] == "ID", "comments": None, "data_default": None} for t in ("ORDERS", "ORDERS_HIST") for c in _COLUMNS]
_CATALOG_TYPE = "owner string, table_name string, column_name string, data_type string, data_precision int, data_scale int, nullable string, column_id int, comments string, data_default string, in_key boolean"


def _catalog(spark: SparkSession, without: tuple[str, ...] = (), reads: list | None = None, rows: list[dict] = _CATALOG) -> catalog.Catalog:
    """The catalog of the synthetic tables; its first read lacks the columns ``without``."""
    reads, every = [] if reads is None else reads, rows

    def load() -> DataFrame:
        reads.append(1)
        rows = [c for c in every if len(reads) > 1 or c["column_name"] not in without]
        return spark.createDataFrame(rows, _CATALOG_TYPE)

    return catalog.Catalog(load)


def _config(**more) -> Config:
    return Config.of({"db.name": "shop-db", "table.whitelist": "SALES", "batch.size": 3} | more)


_KEPT = f"""{REDO},
r0 AS (SELECT * FROM d WHERE seg_owner = 'SALES' AND NOT undone AND status <> 2 AND NOT (k % 101 = 0 AND k % 103 <> 0)),
spans0 AS (SELECT r0.xid, min(r0.seq) AS a, arg_min(r0.scn, r0.seq) AS s, max(t.seq) AS z FROM r0 LEFT JOIN t ON r0.xid = t.xid GROUP BY r0.xid),
low0 AS (SELECT c.xid, (SELECT min(s) FROM spans0 WHERE a < c.seq AND (z IS NULL OR z > c.seq)) AS low FROM t AS c WHERE c.operation = 'COMMIT'),
done0 AS (SELECT r0.*, t.seq AS commit_seq, t.scn AS commit_scn, row_number() OVER (PARTITION BY r0.xid ORDER BY r0.seq) AS ordinal, count(*) OVER (PARTITION BY r0.xid) AS n FROM r0 JOIN t ON r0.xid = t.xid WHERE t.operation = 'COMMIT'),
sent AS (SELECT 'shop-db.SALES.' || table_name AS topic, k, seq, commit_seq, CASE operation WHEN 'DELETE' THEN 'd' WHEN 'INSERT' THEN 'i' ELSE 'u' END AS op, least(scn, low) AS offset_scn, commit_scn AS offset_commit_scn,
    (ordinal - 1) // 3 = (n - 1) // 3 AS offset_complete FROM done0 JOIN low0 USING (xid) WHERE k % 103 <> 0)"""
_SENT = "SELECT topic, k AS key_id, seq, 0 AS part, op, {more} FROM sent UNION ALL SELECT topic, k, seq, 1, NULL, {more} FROM sent WHERE op = 'd'"


def _sent(rows: DataFrame, *more) -> DataFrame:
    return rows.select("topic", F.get_json_object("key", "$.ID").cast("long").alias("key_id"), "seq", "part", F.get_json_object("value", "$.op").alias("op"), *more)


@query(f"{_KEPT} {_SENT.format(more='offset_scn, offset_commit_scn, offset_complete')}")
def cdc_records(spark: SparkSession, sf: str) -> DataFrame:
    """The job as a batch: the whole log to records of all tables of a schema, with offsets and tombstones."""
    log = synth.redo(spark, sf, users=False)
    rows = cdc.texts(log, _config(), _catalog(spark))
    return _sent(rows, F.col("offset.scn").alias("offset_scn"), F.col("offset.commitScn").alias("offset_commit_scn"), F.col("offset.isTransactionComplete").alias("offset_complete"))


@query(f"{_KEPT} {_SENT.format(more='commit_seq')}")
def cdc_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The job as a stream: it ends after half of the log and goes on from its checkpoint; its catalog is out of date at first."""
    base, log, catalog_ = shared.scratch(spark, "stream"), synth.redo(spark, sf, users=False), _catalog(spark, without=("PRIO",))
    from tidemark.streaming import transactions as streaming

    for parts in (range(2), range(2, 4)):
        files = _write_in_parts(spark, log, f"{base}/log", parts)
        cdc.stream(streaming.log_files(spark, f"{base}/log", files), _config(), catalog_, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _sent(spark.read.parquet(f"{base}/out"), "commit_seq")


@query(f"{_KEPT} SELECT topic, key_id, seq * 1000 AS seq, part, op, offset_scn, offset_commit_scn, offset_complete FROM ({_SENT.format(more='offset_scn, offset_commit_scn, offset_complete')})")
def cdc_split(spark: SparkSession, sf: str) -> DataFrame:
    """The job as a batch over a log whose statements are split over several rows."""
    rows = cdc.texts(synth.split(synth.redo(spark, sf, users=False)), _config(), _catalog(spark))
    return _sent(rows, F.col("offset.scn").alias("offset_scn"), F.col("offset.commitScn").alias("offset_commit_scn"), F.col("offset.isTransactionComplete").alias("offset_complete"))


@query(f"""{_KEPT}, v AS (SELECT max(scn) // 2 AS half FROM redo)
SELECT sent.seq, 0 AS part, CASE WHEN op <> 'd' THEN CASE WHEN sent.seq < half THEN replace(placed, ' ', 'T') || '.000Z' ELSE placed END END AS placed FROM sent JOIN o ON sent.k = o.k, v
UNION ALL SELECT seq, 1, NULL FROM sent WHERE op = 'd'""")
def cdc_versions(spark: SparkSession, sf: str) -> DataFrame:
    """With the log's own dictionary: a column is a timestamp up to half of the log, and a text from there on."""
    half = _current(spark, sf) // 2
    later = [c | {"data_type": "VARCHAR2", "data_scale": None} if c["column_name"] == "PLACED" else c for c in _CATALOG]
    rows = [c | {"from_scn": scn} for scn, version in ((1, _CATALOG), (half, later)) for c in version]
    known = catalog.Catalog(lambda: spark.createDataFrame(rows, _CATALOG_TYPE + ", from_scn long"))
    out = cdc.texts(synth.redo(spark, sf, users=False), _config(**{"db.dictionary": "REDO_LOG"}), known)
    return out.select("seq", "part", F.get_json_object("value", "$.after.PLACED").alias("placed"))


_HALF = "(SELECT max(scn) // 2 AS half FROM redo)"
_OFFSETS_OF = ("offset.scn AS offset_scn", "offset.commitScn AS offset_commit_scn", "offset.isTransactionComplete AS offset_complete")
_RESUMED = f"""{_KEPT} SELECT s.*, CASE WHEN offset_commit_scn <= half THEN 0 ELSE 1 END AS batch FROM ({_SENT.format(more='offset_scn, offset_commit_scn, offset_complete')}) AS s, {_HALF}"""


@query(_RESUMED)
def cdc_resume(spark: SparkSession, sf: str) -> DataFrame:
    """The job in two runs to one path, of a log that uses 50 transaction ids again and again: half of it, then all of it from the
    stored offset on.  Every record is there once, with the offset that the whole log gives."""
    path, log = shared.scratch(spark, "resume"), synth.redo(spark, sf, users=False, ids=50)
    half = _current(spark, sf) // 2
    for part in (log.where(F.col("scn") <= half), log):
        cdc.go_on(part, _config(), _catalog(spark), path)
    return _sent(ledger.read(spark, path), *map(F.expr, _OFFSETS_OF), F.col("batch").cast("int").alias("batch"))


@query(f"""{REDO} SELECT d.seq, d.xid, t.seq AS commit_seq, d.table_name, d.operation,
CASE WHEN d.status = 2 THEN 'unreadable' WHEN d.k % 103 = 0 THEN 'unparsable' WHEN d.table_name = 'ORDERS_HIST' THEN 'unknown table' ELSE 'required column is null' END AS reason
FROM d JOIN t ON d.xid = t.xid WHERE t.operation = 'COMMIT' AND d.seg_owner = 'SALES' AND NOT d.undone AND NOT (d.k % 101 = 0 AND d.k % 103 <> 0)
AND (d.status = 2 OR d.k % 103 = 0 OR d.table_name = 'ORDERS_HIST' OR (d.operation = 'INSERT' AND d.k % 7 = 1))""")
def rejected_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Committed changes that give no record, with the reason: of a catalog that lacks a table, and has a column that can't be null."""
    rows = [c | {"nullable": "N" if c["column_name"] == "PRIO" else c["nullable"]} for c in _CATALOG if c["table_name"] == "ORDERS"]
    out = cdc.outcomes(synth.redo(spark, sf, users=False), _config(), _catalog(spark, rows=rows)).where("reason IS NOT NULL")
    return out.select("seq", "change.xid", "commit_seq", "change.table_name", "change.operation", "reason")


@query(f"{_KEPT} {_SENT.format(more='offset_scn, offset_commit_scn, offset_complete')}")
def cdc_stream_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """The offsets of streamed records, with low watermarks over open transactions of all batches and a restart between them."""
    from tidemark.streaming import transactions as streaming

    base, log = shared.scratch(spark, "stream"), synth.redo(spark, sf, users=False, ids=50)
    for parts in (range(1), range(1, 4)):
        files = _write_in_parts(spark, log, f"{base}/log", parts)
        cdc.stream(streaming.log_files(spark, f"{base}/log", files), _config(), _catalog(spark), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _sent(ledger.read(spark, f"{base}/out"), *map(F.expr, _OFFSETS_OF))


@query(f"""{REDO}, h AS (SELECT d.table_name, d.k FROM d JOIN t ON d.xid = t.xid, {_HALF} WHERE t.operation = 'COMMIT' AND d.scn >= half AND t.scn >= half AND NOT d.undone AND d.seg_owner = 'SALES' AND d.status <> 2 AND d.k % 101 <> 0 AND d.k % 103 <> 0)
SELECT 'shop-db.SALES.' || tab AS topic, true AS snapshot, k AS id FROM o, {_HALF} WHERE own = 'SALES' AND (k + 1) * 10 <= half UNION ALL SELECT 'shop-db.SALES.' || table_name, false, k FROM h""")
def cdc_stream_hand_over(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of all tables as of half of the log, then a stream to the same path, which begins at the snapshot's SCN."""
    from tidemark.streaming import transactions as streaming

    base, log, one = shared.scratch(spark, "stream"), synth.redo(spark, sf, users=False, ids=50), _config(**{"tombstones.on.delete": False})
    cdc.write_snapshot(lambda _, table, scn: snapshot.as_of(synth.table(spark, sf, table), scn), _current(spark, sf) // 2, one, _catalog(spark), f"{base}/out")
    files = _write_in_parts(spark, log, f"{base}/log", range(4))
    cdc.stream(streaming.log_files(spark, f"{base}/log", 4 * files), one, _catalog(spark), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    rows = spark.read.option("basePath", f"{base}/out").option("mergeSchema", True).parquet(*[ledger.folder(f"{base}/out", n) for n in ledger.listed(spark, f"{base}/out")])
    return rows.select("topic", (F.get_json_object("value", "$.op") == "r").alias("snapshot"), F.get_json_object("key", "$.ID").cast("long").alias("id"))


@query(f"""{REDO} SELECT 'shop-db.SALES.' || tab AS topic, k AS id, k AS record_id, (k + 1) * 10 AS record_scn FROM o, {_HALF} WHERE own = 'SALES' AND (k + 1) * 10 <= half""")
def snapshot_resume_many(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of two tables in ranges of row ids that ends after two batches, within the first table, then after one more, and then goes on."""
    path, one, half = shared.scratch(spark, "out"), _config(), _current(spark, sf) // 2
    tables = lambda _, table, scn: snapshot.as_of(synth.table(spark, sf, table), scn)
    size = max(tables(None, "ORDERS", half).count() // 4, 1)
    for scn, most in ((half, 2), (half * 2, 1), (half * 2, None)):  # it stays a snapshot of the first SCN
        cdc.write_snapshot(tables, scn, one, _catalog(spark), path, size, most)
    rows = ledger.read(spark, path)
    return rows.select("topic", F.get_json_object("key", "$.ID").cast("long").alias("id"), F.get_json_object("value", "$.after.ID").cast("long").alias("record_id"), F.get_json_object("value", "$.source.scn").cast("long").alias("record_scn"))


@query(f"""{REDO}, h AS (SELECT d.seq, d.k FROM d JOIN t ON d.xid = t.xid, (SELECT max(scn) // 2 AS half FROM redo) WHERE t.operation = 'COMMIT' AND d.scn >= half AND t.scn >= half AND NOT d.undone AND d.seg_owner = 'SALES' AND d.status <> 2 AND d.k % 101 <> 0 AND d.k % 103 <> 0)
SELECT 'snapshot' AS part, o_orderkey AS id FROM orders, (SELECT max(scn) // 2 AS half FROM redo) WHERE (o_orderkey + 1) * 10 <= half UNION ALL SELECT 'log', k FROM h""")
def cdc_hand_over(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot as of half of the log, then the records of the log from its SCN on."""
    log, scn = synth.redo(spark, sf, users=False), _current(spark, sf) // 2
    snap = snapshot.read(snapshot.as_of(_table(spark, sf), scn), "SALES", "ORDERS", scn, CONNECTOR)
    after = cdc.hand_over(scn, log, _config(**{"tombstones.on.delete": False}), _catalog(spark))
    return snap.select(F.lit("snapshot").alias("part"), F.col("after.ID").alias("id")).unionByName(after.select(F.lit("log").alias("part"), F.get_json_object("key", "$.ID").cast("long").alias("id")))


@query("""SELECT event_id, epoch_ms(date_trunc('day', ts)) // 86400000 AS day, epoch_us(ts AT TIME ZONE 'Europe/Berlin') // 1000 AS ms, CASE WHEN event_id % 5 <> 0 THEN event_id END AS number, event_id::VARCHAR || '.25' AS exact FROM events""")
def snapshot_extract(spark: SparkSession, sf: str) -> DataFrame:
    """A table's values by their catalog types: dates cut to the day, wall clocks of a zone, nulls, decimals."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    rows = e.select("event_id", F.col("ts").alias("D"), F.col("ts").cast("timestamp_ntz").alias("T"), F.expr("CASE WHEN event_id % 5 <> 0 THEN CAST(event_id AS DECIMAL(20, 0)) END").alias("N"), F.expr("CAST(concat(event_id, '.25') AS DECIMAL(30, 4))").alias("X"))
    column = lambda name, kind, p, s, k: {"column_name": name, "data_type": kind, "data_precision": p, "data_scale": s, "nullable": "Y", "column_id": k}
    schema, _ = types.row_schemas([column("event_id", "NUMBER", 18, 0, 1), column("D", "DATE", None, None, 2), column("T", "TIMESTAMP(6)", None, 6, 3), column("N", "NUMBER", 12, 0, 4), column("X", "NUMBER", 30, 2, 5)], set())
    got = snapshot.extract(rows, schema, "Europe/Berlin")
    return got.select("event_id", F.unix_date("D").cast("long").alias("day"), F.unix_millis("T").alias("ms"), F.col("N").alias("number"), F.col("X").cast("string").alias("exact"))
