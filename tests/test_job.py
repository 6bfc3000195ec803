"""The whole job: hot transactions, changes of tables, offsets, failures and restarts."""

import decimal
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions import convert, names, types
from tidemark.operators import parse, ranges, reassembly, scan, transactions
from tidemark.plans import cdc
from tidemark.schema import LOG
from tidemark.sources import catalog, snapshot
from tidemark.streaming import transactions as streaming

CODES = {"INSERT": 1, "DELETE": 2, "UPDATE": 3, "COMMIT": 7, "ROLLBACK": 36}
TYPE = "owner string, table_name string, column_name string, data_type string, data_precision int, data_scale int, nullable string, column_id int, in_key boolean"


def row(seq, operation, xid, sql=None, csf=0, status=0, table="T"):
    return (seq, seq, None, operation, CODES[operation], 0, None if CODES[operation] > 3 else "S", None if CODES[operation] > 3 else table, "APP", sql, f"R{seq}", csf, xid, status)


def insert(k, more=""):
    return f"""insert into "S"."T"("ID","A"{more and ',"B"'}) values ('{k}','a{k}'{more})"""


def columns(*extra, **more):
    own = [("ID", "NUMBER", 8, 0, "N"), ("A", "VARCHAR2", None, None, "Y"), *extra]
    return [{"owner": "S", "table_name": "T", "column_name": c, "data_type": t, "data_precision": p, "data_scale": s, "nullable": n, "column_id": i, "in_key": c == "ID"} | more for i, (c, t, p, s, n) in enumerate(own)]


B = ("B", "NUMBER", 8, 0, "Y")


def config(**more):
    return Config.of({"db.name": "db", "table.whitelist": "S.T", "batch.size": 2} | more)


def known(spark, *versions, kind=TYPE):
    """A catalog whose reads give these rows, one after another, and then the last."""
    reads = list(versions)
    return catalog.Catalog(lambda: spark.createDataFrame(reads.pop(0) if len(reads) > 1 else reads[0], kind))


def values(df):
    return sorted((r["seq"], r["part"], r["value"]) for r in df.select("seq", "part", F.get_json_object("value", "$.after.ID").alias("value")).collect())


def apart(parts):
    """Typed records of several tables as texts, each table by itself."""
    rows = [p.withColumn("key", F.to_json("key") if dict(p.dtypes)["key"] != "void" else F.lit(None).cast("string")).withColumn("value", F.to_json("value")) for p in parts.values()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def test_all_tables_in_one_pass(spark):
    """Records as texts are those of each table: with and without a key, tombstones, and inserts that lack a required column."""
    sql = lambda t, k, a: f"""insert into "S"."{t}"("ID","A") values ('{k}',{a})"""
    gone = lambda t, k: f"""delete from "S"."{t}" where "ID" = '{k}' and "A" = 'x'"""
    new = lambda t, k: f"""update "S"."{t}" set "A" = 'y' where "ID" = '{k}' and "A" = 'x'"""
    log, seq = [], 0
    for t in ("T", "U", "V"):
        for op, text in (("INSERT", sql(t, 1, "'x'")), ("INSERT", sql(t, 2, "NULL")), ("UPDATE", new(t, 1)), ("DELETE", gone(t, 1))):
            seq += 1
            log.append(row(seq, op, "X", text, table=t))
    log = spark.createDataFrame([*log, row(seq + 1, "COMMIT", "X")], LOG)
    required = [c | {"nullable": "N"} for c in columns(table_name="U")]
    keyless = [c | {"in_key": False} for c in columns(table_name="V")]
    one, known_ = config(**{"table.whitelist": "S"}), known(spark, columns() + required + keyless)
    texts = cdc.texts(log, one, known_)
    told = lambda df: sorted((r["topic"], r["seq"], r["part"], r["key"], r["value"], r["offset"]) for r in df.withColumn("value", F.regexp_replace("value", ',"ts_ms":"[^"]*"}$', "}")).withColumn("key", F.coalesce("key", F.lit("none"))).withColumn("value", F.coalesce("value", F.lit("none"))).collect())
    got = told(texts)
    assert got == told(apart(cdc.records(log, one, known_)))
    assert [(t, s, p) for t, s, p, *_ in got] == [(f"db.S.{t}", 4 * i + n, p) for i, t in enumerate("TUV") for n, p in ((1, 0), (2, 0), (3, 0), (4, 0), (4, 1)) if (t, n) != ("U", 2)]
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Union" not in plan.split("Join")[0]
    assert cdc.texts(log, config(**{"table.whitelist": "NONE"}), known_).isEmpty()


def test_a_commit_counts_whatever_its_status(spark):
    log = spark.createDataFrame([row(1, "INSERT", "X", insert(1)), row(2, "INSERT", "X", insert(2), status=2), row(3, "COMMIT", "X", status=2)], LOG)
    assert values(cdc.texts(log, config(), known(spark, columns()))) == [(1, 0, "1")]


def test_hot_transaction(spark, monkeypatch):
    """90 % of the rows in one transaction, statements in pieces: ranks, sizes and texts, counted in many ranges."""
    monkeypatch.setattr(ranges, "BITS", 6)
    rows, seq, drawn = [], 0, random.Random(1)
    for k in range(2000):
        xid, text = "HOT" if drawn.random() < 0.9 else f"X{k % 7}", insert(k)
        cut = sorted(drawn.sample(range(1, len(text)), drawn.choice([0, 0, 1, 5])))
        for i, (a, b) in enumerate(zip([0, *cut], [*cut, len(text)])):
            seq += 1
            rows.append(row(seq, "INSERT", xid, text[a:b], csf=int(b < len(text))))
    ends = {x: seq + 1 + i for i, x in enumerate(sorted({r[12] for r in rows}))}
    rows += [row(at, "COMMIT", x) for x, at in ends.items()]
    log = spark.createDataFrame(rows, LOG).repartition(9)
    whole = reassembly.reassemble(log)
    got = transactions.emission_order(transactions.committed_changes(whole)).select("xid", "seq", "sql_redo", "ordinal", "place").orderBy("place").collect()
    texts = [r for r in got]
    assert [r["place"] for r in texts] == list(range(1, 2001)) and Counter(r["sql_redo"] for r in texts) == Counter(insert(k) for k in range(2000))
    assert [(r["xid"], r["seq"]) for r in texts] == sorted(((r["xid"], r["seq"]) for r in texts), key=lambda x: (ends[x[0]], x[1]))
    at = Counter()
    for r in texts:
        at[r["xid"]] += 1
        assert r["ordinal"] == at[r["xid"]]
    offsets = transactions.record_offsets(whole, 100).collect()
    last = {x: n - (n - 1) % 100 for x, n in at.items()}
    assert len(offsets) == 2000 and all(r["offset"]["isTransactionComplete"] == (r["ordinal"] >= last[r["xid"]]) for r in offsets)


def test_a_reused_transaction_id(spark):
    log = [row(1, "INSERT", "X", insert(1)), row(2, "ROLLBACK", "X"), row(3, "INSERT", "X", insert(2)), row(4, "COMMIT", "X"), row(5, "INSERT", "X", insert(3)), row(6, "COMMIT", "X"), row(7, "INSERT", "X", insert(4))]
    got = transactions.record_offsets(spark.createDataFrame(log, LOG), 10).orderBy("seq").collect()
    assert [(r["seq"], r["commit_seq"], r["ordinal"], r["offset"]["scn"], r["offset"]["isTransactionComplete"]) for r in got] == [(3, 4, 1, 3, True), (5, 6, 1, 5, True)]


def test_an_unknown_column_is_read_again_once_and_then_an_error(spark, tmp_path):
    log = spark.createDataFrame([row(1, "INSERT", "X", insert(1)), row(2, "INSERT", "X", insert(2, ",'7'")), row(3, "COMMIT", "X")], LOG)
    with pytest.raises(Exception, match="unknown column of this schema: B"):
        cdc.texts(log, config(), known(spark, columns())).collect()
    cdc.write(log, config(), known(spark, columns(), columns(B)), str(tmp_path / "a"))
    got = spark.read.parquet(str(tmp_path / "a")).select("seq", F.get_json_object("value", "$.after.B").alias("b")).orderBy("seq").collect()
    assert [(r["seq"], r["b"]) for r in got] == [(1, None), (2, "7")]
    with pytest.raises(Exception, match="unknown column"):
        cdc.write(log, config(), known(spark, columns()), str(tmp_path / "b"))


def test_versions_of_a_table(spark):
    """With the log's own dictionary each change is read by the columns that its table had then."""
    versions = columns(from_scn=1) + columns(B, from_scn=4)
    log = spark.createDataFrame([row(2, "INSERT", "X", insert(1)), row(5, "INSERT", "X", insert(2, ",'7'")), row(6, "COMMIT", "X")], LOG)
    parts = cdc.records(log, config(**{"db.dictionary": "REDO_LOG"}), known(spark, versions, kind=TYPE + ", from_scn long"))
    assert list(parts) == [("S", "T", 1), ("S", "T", 4)]
    assert [p.schema["value"].dataType["after"].dataType.names for p in parts.values()] == [["ID", "A"], ["ID", "A", "B"]]
    assert values(apart(parts)) == [(2, 0, "1"), (5, 0, "2")]


def random_log(n, seed):
    """Nine open transactions at a time; an id is used once, or a log that is read from its middle could not tell."""
    drawn, rows, open_, used = random.Random(seed), [], set(), Counter()
    for seq in range(1, n + 1):
        slot = drawn.randrange(9)
        xid = f"X{slot}.{used[slot]}"
        if xid in open_ and drawn.random() < 0.25:
            rows.append(row(seq, drawn.choice(["COMMIT", "COMMIT", "ROLLBACK"]), xid))
            open_.discard(xid)
            used[slot] += 1
        else:
            rows.append(row(seq, "INSERT", xid, insert(seq)))
            open_.add(xid)
    return rows


def test_a_stored_offset_is_gone_on_from(spark, tmp_path):
    """The log in two runs: the second begins at the offset of the first one's last record; nothing is lost."""
    rows = random_log(400, 5)
    whole = values(cdc.texts(spark.createDataFrame(rows, LOG), config(), known(spark, columns())))
    cdc.write(spark.createDataFrame(rows[:230], LOG), config(), known(spark, columns()), str(tmp_path / "one"))
    at = cdc.stored_offset(spark, str(tmp_path / "one"))
    assert snapshot.plan(at) == ("log", at) and snapshot.plan(None)[0] == "snapshot" and snapshot.plan(None, 7)[1]["scn"] == 7
    cdc.write(spark.createDataFrame(rows, LOG), config(), known(spark, columns()), str(tmp_path / "two"), scn=at["scn"], commit_scn=at["commitScn"], complete=at["isTransactionComplete"])
    one, two = (values(spark.read.parquet(str(tmp_path / x))) for x in ("one", "two"))
    # at least once: a commit of several batches may come again
    assert sorted(set(one) | set(two)) == whole and len(set(one) & set(two)) == 0


def test_a_stream_that_fails_goes_on_without_loss_or_repeats(spark, tmp_path, monkeypatch):
    rows = random_log(300, 6)
    for i in range(3):
        spark.createDataFrame(rows[100 * i : 100 * i + 100], LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    monkeypatch.setattr(streaming, "PART", 3)
    failures, make = [ConnectionError("connection lost"), ConnectionError("connection lost")], cdc.texts_of

    def fails(parsed, *rest):
        if failures and parsed.count():
            raise failures.pop()
        return make(parsed, *rest)

    monkeypatch.setattr(cdc, "texts_of", fails)
    start = lambda: cdc.stream(streaming.log_files(spark, str(tmp_path / "log")), config(), known(spark, columns()), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    with pytest.raises(Exception, match="connection lost"):
        streaming.supervise(start, ("no such",), 3, 1)
    streaming.supervise(start, ("connection lost",), 3, 1)
    assert not failures
    got = values(spark.read.parquet(str(tmp_path / "out")))
    assert got == values(cdc.texts(spark.createDataFrame(rows, LOG), config(), known(spark, columns())))


def test_stream_progress(spark, tmp_path):
    spark.createDataFrame(random_log(20, 1), LOG).coalesce(1).write.parquet(str(tmp_path / "log"))
    streaming.use_rocksdb(spark)
    query = streaming.write(streaming.committed(streaming.log_files(spark, str(tmp_path / "log"))), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert [b for b, rate in streaming.throughput(query) if rate > 0] == [0]


def test_both_statements_of_the_number_types(spark):
    cases = [(k, p, s) for k in ("NUMBER", "DATE", "TIMESTAMP(3)", "CLOB", "BINARY_FLOAT") for p in (None, 0, 1, 2, 3, 4, 5, 9, 10, 18, 19, 30, 38) for s in (None, -84, -3, 0, 1, 4, 20)]
    rows = spark.createDataFrame(cases, "kind string, p int, s int")
    got = rows.select("kind", "p", "s", types.type_name(F.col("kind"), F.col("p"), types.scale_or_null(F.col("s"), F.col("p"))).alias("t")).collect()
    for r in got:
        want = types.data_type(r["kind"], r["p"], r["s"]) if r["t"] else None
        assert want is None or want.simpleString() == r["t"], r


def test_decimals_are_exact_or_an_error(spark):
    drawn = random.Random(2)
    texts = ["30.516658782958984", "0", "-0.0", "1E3", "1.50e-1", "12345678901234567890.5", "00012.3400", ".5", "5.", " 7 ", "9" * 39, "x", None]
    texts += ["".join([drawn.choice(["", "-", "+"]), str(drawn.randrange(10 ** drawn.randrange(1, 22))), "." + str(drawn.randrange(10 ** drawn.randrange(1, 22))) * drawn.randrange(2), drawn.choice(["", "", "0000", "e2", "E-3"])]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for p, s in ((38, 20), (38, 10), (38, 0), (20, 2), (5, 5)):
        for r in df.withColumn("d", convert.decimal(F.col("t"), p, s, strict=False)).collect():
            try:
                with decimal.localcontext(decimal.Context(prec=100)):
                    exact = decimal.Decimal(r["t"].strip())
                    fits = exact == exact.quantize(decimal.Decimal(1).scaleb(-s)) and abs(exact) < decimal.Decimal(10) ** (p - s)
            except (decimal.InvalidOperation, AttributeError):
                fits = False
            assert (r["d"] is not None) == fits and (not fits or r["d"] == exact), (r["t"], p, s, r["d"])
    with pytest.raises(Exception, match="no decimal"):
        df.where("i = 0").select(convert.decimal(F.col("t"), 38, 10)).collect()


def test_fractions_of_seconds(spark):
    df = spark.createDataFrame([("2020-01-27 06:00:00", "2020-01-27 06:00:00.123456789")], "a string, b string")
    r = df.select(F.unix_millis(convert.timestamp(F.col("a"), "UTC", 0)).alias("a"), F.unix_millis(convert.timestamp(F.col("b"), "UTC", 9)).alias("b")).first()
    assert (r["a"], r["b"]) == (1580104800000, 1580104800123)


def test_defaults_are_attached(spark):
    made = lambda kind, text, nullable="Y", p=8: types.default_value(types.field({"column_name": "C", "data_type": kind, "data_precision": p, "data_scale": 0, "nullable": nullable, "data_default": text}), "UTC")
    got = spark.range(1).select(made("NUMBER", " 7 ").alias("a"), made("VARCHAR2", " 'N' ").alias("b"), made("DATE", "DATE '2018-04-12'").cast("string").alias("c"), made("DATE", "sysdate").alias("d"), made("NUMBER", None).alias("e"))
    assert tuple(got.first()) == (7, "N", "2018-04-12", None, None)
    assert made("NUMBER", None, "N") is None


def test_names(spark):
    r = spark.createDataFrame([("MY_TABLE_T", "db.S.T")], "t string, topic string").select(names.record_name(F.col("t")).alias("n"), *[c.alias(k) for k, c in names.record_names(F.col("topic")).items()]).first()
    assert tuple(r) == ("My_table", "db.S.T.Envelope", "db.S.T.Key", "db.S.T.Value") and names.table_id("A.B.C") == ("A", "B")
    with pytest.raises(ValueError):
        names.table_id("A")


def test_rows_after_one_and_gaps(spark):
    log = spark.createDataFrame(random_log(50, 3), LOG)
    assert scan.after_row(log, 30).count() == 20 and not scan.gap(log, 1).first()["gap"] and scan.gap(log, 1).first()["first_scn"] == 1
    torn = spark.createDataFrame([row(1, "INSERT", "X", "a", 1), row(2, "INSERT", "Y", "b", 0), row(3, "INSERT", "X", "c", 0)], LOG)
    assert [r["seq"] for r in reassembly.not_contiguous(torn).collect()] == [1] and reassembly.not_contiguous(log).isEmpty()
    assert parse.unparsable(torn).count() == 3


def test_tables_of_selectors(spark):
    cols = spark.createDataFrame(columns() + columns(owner="S", table_name="U"), TYPE)
    assert catalog.tables_of(cols, config(**{"table.whitelist": "S, S.T, Q.V"}).selectors) == [("S", "T"), ("S", "U"), ("S", "T"), ("Q", "V")]
    with pytest.raises(LookupError):
        known(spark, columns()).schemas("Q", "V")


def test_snapshot_values_need_their_schema(spark):
    value, _ = types.row_schemas(columns(B), {"ID"})
    with pytest.raises(ValueError, match="no column B"):
        snapshot.extract(spark.createDataFrame([(1, "a")], "ID int, A string"), value, "UTC")
    with pytest.raises(ValueError, match="lacks"):
        snapshot.extract(spark.createDataFrame([(1, "a", 2, 3)], "ID int, A string, B int, C int"), value, "UTC")
