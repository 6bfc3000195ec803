"""What a job delivers over several runs: resumes with reused ids, the list of batches, rejected changes, order, streams from an offset."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from test_job import B, TYPE, columns, config, insert, known, row
from tidemark import shared
from tidemark.operators import scan, transactions
from tidemark.plans import cdc, ledger
from tidemark.schema import LOG
from tidemark.sources import adapters
from tidemark.streaming import transactions as streaming


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small logs: their jobs are many and short."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def reused_log(n, seed):
    """Nine ids that are used again and again; some terminators and changes of one SCN."""
    drawn, rows, open_ = random.Random(seed), [], set()
    for seq in range(1, n + 1):
        xid = f"X{drawn.randrange(9)}"
        if xid in open_ and drawn.random() < 0.25:
            rows.append(row(seq, drawn.choice(["COMMIT", "COMMIT", "ROLLBACK"]), xid))
            open_.discard(xid)
        else:
            rows.append(row(seq, "INSERT", xid, insert(seq), status=2 * (drawn.random() < 0.05)))
            open_.add(xid)
    return rows


def told(df):
    return sorted((r["seq"], r["commit_seq"], r["ordinal"], *r["offset"]) for r in df.select("seq", "commit_seq", "ordinal", "offset").collect())


def records(df):
    return sorted((r["seq"], r["part"], r["commit_seq"], *r["offset"]) for r in df.select("seq", "part", "commit_seq", "offset").collect())


def dml(scn, xid):
    return row(scn, "INSERT", xid, insert(scn))


def test_a_finished_id_that_is_used_again_after_the_offset(spark):
    """A delivered change doesn't come again under a later commit, a rolled-back one never, and neither pins the low watermark."""
    log = spark.createDataFrame([dml(90, "T0"), dml(100, "T1"), row(150, "COMMIT", "T1"), dml(200, "T1"), row(210, "COMMIT", "T1"), row(300, "COMMIT", "T0"), dml(400, "T2"), row(410, "COMMIT", "T2")], LOG)
    first = told(cdc.changes(log.where("scn <= 170"), config()))
    assert first == [(100, 150, 1, "cdc", 90, 150, True)]
    assert told(cdc.changes(log, config(), 90, 150, True)) == [r for r in told(cdc.changes(log, config())) if r[1] > 150] and told(cdc.changes(log, config(), 90, 150, True))[-1][4] == 400
    log = spark.createDataFrame([dml(90, "T0"), dml(95, "T3"), row(99, "ROLLBACK", "T3"), dml(100, "T1"), row(150, "COMMIT", "T1"), dml(200, "T3"), row(210, "COMMIT", "T3")], LOG)
    assert told(cdc.changes(log, config(), 90, 150, True)) == [(200, 210, 1, "cdc", 90, 210, True)]


@pytest.mark.parametrize("seed, cut", [(1, 60), (2, 150), (3, 231)])
def test_a_resume_gives_the_rest_of_the_whole_log(spark, seed, cut):
    """At any place: every change after the offset once, with the offsets that the whole log gives."""
    log = spark.createDataFrame(reused_log(300, seed), LOG)
    whole, first = told(cdc.changes(log, config())), cdc.changes(log.where(F.col("seq") <= cut), config())
    last = first.agg(F.max_by(F.struct("offset.*", F.col("commit_seq").alias("commitSeq")), F.struct("commit_seq", "seq")).alias("at")).first()["at"].asDict()
    rest = [r for r in whole if r[1] > last["commitSeq"]]
    assert len(rest) > 20
    assert told(cdc.changes(log, config(), **cdc.bounds_of(last))) == rest
    # the same by SCNs alone, as an offset of another tool has no places
    assert told(cdc.changes(log, config(), last["scn"], last["commitScn"], True)) == rest
    # of a transaction that was broken off all comes again
    assert told(cdc.changes(log, config(), last["scn"], last["commitScn"], False)) == [r for r in whole if r[1] >= last["commitSeq"]]


def test_batches_are_listed_once_they_are_whole(spark, tmp_path, monkeypatch):
    """Two writes to one path keep both, an empty run keeps the offset, and one that is killed loses and repeats nothing."""
    path, rows, catalog = str(tmp_path / "out"), reused_log(200, 4), known(spark, columns())
    log = lambda n: spark.createDataFrame(rows[:n], LOG)
    assert cdc.stored_offset(spark, path) is None and ledger.read(spark, path) is None
    cdc.go_on(log(90), config(), catalog, path)
    at = cdc.stored_offset(spark, path)
    assert cdc.go_on(log(90), config(), catalog, path)["counts"] == {} and cdc.stored_offset(spark, path) == at and at["commitSeq"] <= 90
    monkeypatch.setattr(ledger, "put", lambda *_: (_ for _ in ()).throw(ConnectionError("killed")))
    with pytest.raises(ConnectionError):
        cdc.go_on(log(120), config(), catalog, path)
    monkeypatch.undo()
    assert ledger.listed(spark, path) == [0, 1] and len(shared.names(spark, path)) == 5  # three batches, one of them not listed
    assert cdc.stored_offset(spark, path) == at and {r["batch"] for r in ledger.read(spark, path).select("batch").collect()} == {0}
    cdc.go_on(log(200), config(), catalog, path)
    got = ledger.read(spark, path)
    assert records(got) == records(cdc.texts(log(200), config(), catalog)) and {r["batch"] for r in got.select("batch").collect()} == {0, 2}
    assert ledger.entry(spark, path, 0)["source"] == {"db": "db"}


def test_rejected_changes_have_a_reason(spark, tmp_path):
    """Records and rejected changes together are the committed changes; a catalog that is out of date is read again once, and only what didn't fit is typed again."""
    path, log = str(tmp_path / "out"), []
    texts = [insert(1), insert(2, ",'7'"), "alter table x", insert(3), """insert into "S"."T"("A") values ('x')""", insert(4), """delete from "S"."T" where "ID" = '1'""", insert(5)]
    for k, x in enumerate(texts):
        log.append(row(k + 1, "DELETE" if x.startswith("delete") else "INSERT", f"X{k % 2}", x, status=2 * (k == 3), table="GONE" if k == 5 else "T"))
    log += [row(20, "COMMIT", "X0"), row(21, "COMMIT", "X1"), row(22, "INSERT", "X2", "rolled back"), row(23, "ROLLBACK", "X2"), row(24, "INSERT", "X3", "open")]
    df, one = spark.createDataFrame(log, LOG), config(**{"table.whitelist": "S"})
    reads = []
    versions = [columns(), columns(B)]

    def load():
        reads.append(1)
        return spark.createDataFrame(versions[min(len(reads), 2) - 1], TYPE)

    entry = cdc.write(df, one, cdc.Catalog(load), path)
    assert entry["counts"] == {"record": 4, "tombstone": 1, cdc.UNREADABLE: 1, cdc.UNPARSABLE: 1, cdc.NO_TABLE: 1, cdc.INVALID: 1} and len(reads) == 2
    gone = {r["seq"]: r["reason"] for r in ledger.read(spark, path, "_rejected").collect()}
    assert gone == {3: cdc.UNPARSABLE, 4: cdc.UNREADABLE, 5: cdc.INVALID, 6: cdc.NO_TABLE}
    assert [r["sql_redo"] for r in ledger.read(spark, path, "_rejected").where("seq = 3").collect()] == ["alter table x"]
    got = {(r["seq"], r["part"]): r["b"] for r in ledger.read(spark, path).select("seq", "part", F.get_json_object("value", "$.after.B").alias("b")).collect()}
    assert got == {(1, 0): None, (2, 0): "7", (7, 0): None, (7, 1): None, (8, 0): None}
    whole = cdc.outcomes(df, one, known(spark, columns(B))).groupBy("reason", "part").count().collect()
    assert {r["reason"] or r["part"]: r["count"] for r in whole} == {0: 4, 1: 1, cdc.UNREADABLE: 1, cdc.UNPARSABLE: 1, cdc.NO_TABLE: 1, cdc.INVALID: 1}


def test_many_tables_and_versions_make_a_small_plan(spark):
    """500 tables of three versions: each change is typed by its table's columns at its SCN."""
    rows = []
    for t in range(500):
        for v, scn in enumerate((1, 100, 200)):
            kinds = (("NUMBER", 8, 0), ("DATE", None, None), ("NUMBER", 30, 2))[: v + 1]
            rows += [c | {"from_scn": scn} for c in columns(*((f"C{k}", *kind, "Y") for k, kind in enumerate(kinds)), table_name=f"T{t}")]
    catalog = known(spark, rows, kind=TYPE + ", from_scn long")
    log, seq = [], 0
    for scn, text in ((50, "(\"ID\",\"C0\") values ('1','7')"), (150, "(\"ID\",\"C0\",\"C1\") values ('1','7',DATE ' 2020-01-02')"), (250, "(\"ID\",\"C2\",\"A\") values ('1','2.50','é\"x')")):
        for t in (0, 7, 499):
            seq += 1
            log.append((seq, scn, *row(seq, "INSERT", "X", f'insert into "S"."T{t}"{text}', table=f"T{t}")[2:]))
    log = spark.createDataFrame([*log, (99, 300, *row(99, "COMMIT", "X")[2:])], LOG)
    one = config(**{"table.whitelist": "S", "db.dictionary": "REDO_LOG"})
    begin = time.time()
    texts = cdc.texts(log, one, catalog)
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert time.time() - begin < 60 and len(plan) < 400_000
    after = {r["seq"]: r["after"] for r in texts.select("seq", F.regexp_extract("value", r'"after":(\{[^}]*\})', 1).alias("after")).collect()}
    assert after == {k: x for k, x in enumerate(['{"ID":1,"C0":7}'] * 3 + ['{"ID":1,"C0":7,"C1":"2020-01-02"}'] * 3 + ['{"ID":1,"A":"é\\"x","C2":2.50}'] * 3, 1)}
    typed = cdc.records(log, config(**{"table.whitelist": "S.T7", "db.dictionary": "REDO_LOG"}), catalog)
    assert {r["seq"]: r["x"] for p in typed.values() for r in p.select("seq", F.to_json("value.after").alias("x")).collect()} == {k: after[k] for k in (2, 5, 8)}
    with pytest.raises(Exception, match="unknown column of this schema: C2"):
        cdc.texts(log, config(**{"table.whitelist": "S.T7"}), known(spark, [c for c in rows if c["from_scn"] == 100], kind=TYPE + ", from_scn long")).collect()
    with pytest.raises(LookupError):
        cdc.texts(log, config(**{"table.whitelist": "S.GONE"}), catalog)


def in_order(spark, path):
    """The places of records as they lie in files, by the names of batches and files."""
    out = []
    for n in ledger.listed(spark, path):
        for name in shared.names(spark, ledger.folder(path, n)):
            if name.startswith("part-"):
                out += [(r["commit_seq"], r["seq"], r["part"]) for r in spark.read.parquet(f"{ledger.folder(path, n)}/{name}").coalesce(1).collect()]
    return out


def test_a_stream_has_the_offsets_and_the_order_of_the_batch_job(spark, tmp_path):
    """Over a restart, with open transactions, rollbacks and reused ids; then from start.scn, and from the offset of a batch job."""
    rows, catalog = reused_log(240, 7), known(spark, columns())
    log, path = spark.createDataFrame(rows, LOG), str(tmp_path / "out")

    def run(name, parts, one, **more):
        for i in parts:
            spark.createDataFrame(rows[80 * i : 80 * i + 80], LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "log"))
        cdc.stream(streaming.log_files(spark, str(tmp_path / name / "log")), one, catalog, str(tmp_path / name / "out"), str(tmp_path / name / "checkpoint"), **more).awaitTermination()
        return ledger.read(spark, str(tmp_path / name / "out"))

    run("a", (0,), config())
    got = run("a", (1, 2), config())
    whole = cdc.texts(log, config(), catalog)
    assert records(got) == records(whole)
    order = in_order(spark, str(tmp_path / "a" / "out"))
    assert order == sorted(order) and len(order) == whole.count()
    assert len(shared.names(spark, str(tmp_path / "a" / "out" / "_open"))) == 2  # the last two
    rejected = ledger.read(spark, str(tmp_path / "a" / "out"), "_rejected")
    assert {r["reason"] for r in rejected.select("reason").collect()} == {cdc.UNREADABLE}

    cdc.go_on(log.where("seq <= 100"), config(), catalog, path)
    order = in_order(spark, path)
    assert order == sorted(order) and len(order) > 10
    at = cdc.stored_offset(spark, path)
    assert records(run("b", (0, 1, 2), config(), at=at)) == [r for r in records(whole) if r[2] > at["commitSeq"]]

    late = run("c", (0, 1, 2), config(**{"start.scn": 101}))
    assert records(late) == records(cdc.texts(log, config(), catalog, scn=101, commit_scn=101, complete=False)) and min(r[0] for r in records(late)) >= 101


def test_rows_of_one_id_are_sorted_in_runs(spark, tmp_path, monkeypatch):
    """Batches of many runs of three rows, in no order, with ids used again within and across batches, give what the batch job gives."""
    monkeypatch.setattr(streaming, "PART", 3)
    monkeypatch.setattr(streaming, "BLOCK", 2)
    streaming.use_rocksdb(spark)
    drawn, rows = random.Random(5), []
    for seq in range(1, 601):
        end = drawn.random() < 0.02
        rows.append(row(seq, drawn.choice(["COMMIT", "ROLLBACK"]) if end else "INSERT", f"X{seq % 2}", None if end else insert(seq)))
    for k in range(3):
        some = rows[200 * k : 200 * k + 200]
        drawn.shuffle(some)
        spark.createDataFrame(some, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        time.sleep(0.05)
    streaming.write(streaming.committed(streaming.log_files(spark, str(tmp_path / "log"))), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = [(r["seq"], r["commit_seq"]) for r in spark.read.parquet(str(tmp_path / "out")).select("seq", "commit_seq").collect()]
    want = [(r["seq"], r["commit_seq"]) for r in transactions.committed_changes(spark.createDataFrame(rows, LOG)).select("seq", "commit_seq").collect()]
    assert sorted(got) == sorted(want) and len(want) > 100


def test_a_snapshot_that_was_broken_off_goes_on_and_hands_over(spark, tmp_path):
    """Tables that are listed are not read again, the SCN stays that of the first attempt, and the log begins there."""
    path, log = str(tmp_path / "out"), spark.createDataFrame(reused_log(120, 8), LOG)
    catalog, one = known(spark, columns() + columns(table_name="U")), config(**{"table.whitelist": "S.T, S.U, S.T"})
    asked, fails = [], [ConnectionError("connection lost")]

    def tables(owner, table, scn):
        asked.append((table, scn))
        if table == "U" and fails:
            raise fails.pop()
        return spark.createDataFrame([(k, f"{table}{k}", f"R{k}", k) for k in range(3)], "ID int, A string, row_id string, row_scn long")

    with pytest.raises(ConnectionError):
        cdc.write_snapshot(tables, 50, one, catalog, path)
    assert cdc.write_snapshot(tables, 99, one, catalog, path) == 50 and asked == [("T", 50), ("U", 50), ("U", 50)]
    assert cdc.write_snapshot(tables, 99, one, catalog, path) == 50 and len(asked) == 3
    assert cdc.stored_offset(spark, path) == {"type": "select", "scn": 50, "owner": "S", "table": "U", "rowId": "R2"}
    assert cdc.begin(spark, one, path) == {"scn": 50, "commit_scn": 50, "complete": False, "done_seq": None}
    cdc.go_on(log, one, catalog, path)
    got = Counter((r["topic"], r["op"]) for r in ledger.read(spark, path).select("topic", F.get_json_object("value", "$.op").alias("op")).collect())
    after = cdc.changes(log, one, 50, 50, False).count()
    assert got == {("db.S.T", "r"): 3, ("db.S.U", "r"): 3, ("db.S.T", "i"): after} and after > 10


def test_a_snapshot_in_ranges_goes_on_after_the_last_row(spark, tmp_path):
    """Row ids that are numbers (9 is before 10), tables without rows and of one range, ends after each batch: every row is there once, in
    ranges that don't overlap, and the log can't begin before the end."""
    path, catalog = str(tmp_path / "out"), known(spark, columns() + columns(table_name="U") + columns(table_name="V"))
    one, sizes = config(**{"table.whitelist": "S.T, S.U, S.V"}), {"T": 40, "U": 0, "V": 3}
    tables = lambda owner, table, scn: spark.range(sizes[table]).selectExpr("CAST(id AS INT) AS ID", "concat('" + table + "', id) AS A", "id * 3 AS row_id", "1L AS row_scn")
    n = 0
    while not n or ledger.entry(spark, path, n - 1)["open"]:
        if n:
            with pytest.raises(ValueError, match="not whole"):
                cdc.begin(spark, one, path)
        assert cdc.write_snapshot(tables, 50 + n, one, catalog, path, 10, 1) == 50
        n += 1
        assert ledger.listed(spark, path) == list(range(n)) and n < 20
    assert cdc.begin(spark, one, path)["scn"] == 50 and cdc.write_snapshot(tables, 99, one, catalog, path, 10) == 50 and len(ledger.listed(spark, path)) == n
    got = [(r["batch"], r["topic"][-1], int(r["row_id"])) for r in ledger.read(spark, path).select("batch", "topic", "row_id").collect()]
    assert sorted(r[1:] for r in got) == [("T", 3 * k) for k in range(40)] + [("V", 3 * k) for k in range(3)]
    in_t = sorted(r for r in got if r[1] == "T")
    assert [r[2] for r in in_t] == [3 * k for k in range(40)] and len({r[0] for r in in_t}) >= 4

    # a table that isn't selected any more doesn't keep the snapshot open, and one that is new can't come after the log
    short = str(tmp_path / "short")
    cdc.write_snapshot(tables, 50, one, catalog, short, 100, 1)
    less = config(**{"table.whitelist": "S.T"})
    cdc.write_snapshot(tables, 50, less, catalog, short, 100)
    assert cdc.begin(spark, less, short)["scn"] == 50
    cdc.go_on(spark.createDataFrame(reused_log(120, 8), LOG), less, catalog, short)
    with pytest.raises(ValueError, match="has the log already"):
        cdc.write_snapshot(tables, 50, one, catalog, short, 100)


def test_a_range_is_a_query_of_its_own():
    assert adapters.snapshot_query("S", "T", 7).endswith("AS OF SCN 7 t") and adapters.snapshot_query("S", "T", 7, "A").endswith(" t WHERE t.ROWID > 'A'")
    assert adapters.snapshot_query("S", "T", 7, "A", "B").endswith(" t WHERE t.ROWID > 'A' AND t.ROWID <= 'B'")


def test_the_bounds_of_the_scan_stay_those_of_the_offset(spark):
    assert scan.bounds(90, 150, True) == (90, 151) and scan.bounds(150, 150, True) == (151, 151) and scan.bounds(90, 150, False) == (90, 150)
    rows = spark.createDataFrame(reused_log(60, 9), LOG)
    assert transactions.unfinished(rows, 0).count() == 60 and transactions.unfinished(rows, 10**6).where("operation <> 'INSERT'").isEmpty()
