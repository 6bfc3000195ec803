"""What a row or a transaction costs, told by plans and by calls."""

import datetime
import json
import re

from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.config import Config
from tidemark.operators import asof, reassembly, transactions
from tidemark.plans import cdc
from tidemark.plans import queries as core
from tidemark.schema import LOG
from tidemark.streaming import transactions as streaming


class State:
    """A state that counts its calls."""

    def __init__(self, calls):
        self.calls, self.held = calls, None

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name == "appendList":
                self.held = (self.held or []) + args[0]
            elif name == "update":
                self.held = args[0]
            elif name == "clear":
                self.held = None
            return self.held is not None if name == "exists" else iter(self.held or []) if name == "get" and not isinstance(self.held, tuple) and self.held else self.held

        return call


def test_a_transaction_within_a_batch_asks_the_state_once():
    calls = []
    tx = streaming.Transactions()
    tx.open, tx.begin, tx.runs = State(calls), State(calls), State(calls)
    row = lambda seq, op: Row(*streaming.FIELDS)(seq, seq, None, op, 1, "S", "T", "APP", "x", "R", 0, "T1", 0)
    told = list(tx.handleInputRows(("T1",), iter([row(1, "INSERT"), row(3, "COMMIT"), row(2, "DELETE")]), None))
    assert [(r["seq"], r["commit_seq"], r["what"]) for r in told] == [(1, 3, "change"), (2, 3, "change"), (None, 3, "ended")]
    assert calls == ["get"]
    told = list(tx.handleInputRows(("T1",), iter([row(5, "INSERT")]), None)) + list(tx.handleInputRows(("T1",), iter([row(7, "COMMIT"), row(6, "DELETE")]), None))
    assert [(r["seq"], r["commit_seq"], r["what"]) for r in told] == [(None, None, "opened"), (5, 7, "change"), (6, 7, "change"), (None, 7, "ended")]
    assert tx.open.held is None and tx.begin.held is None


class Map:
    """A state of keys and values that counts its calls."""

    def __init__(self, calls):
        self.calls, self.held = calls, {}

    def __getattr__(self, name):
        own = {"iterator": lambda: list(self.held.items()), "updateValue": self.held.__setitem__, "getValue": self.held.get, "removeKey": self.held.pop, "clear": self.held.clear}

        def call(*args):
            self.calls.append(name)
            return own[name](*args)

        return call


def test_transactions_within_a_batch_ask_the_state_once_for_all(spark):
    calls = []
    tx = streaming.Group(part=4, block=1)
    tx.begins, tx.open, tx.runs = Map(calls), Map(calls), Map(calls)
    row = lambda seq, xid, op: Row("row", "group")(json.dumps({str(k): v for k, v in enumerate((seq, seq, None, op, 1, "S", "T", "APP", "x", "R", 0, xid, 0))}), 5)
    of = lambda r: (None, None) if r["row"] is None else [json.loads(r["row"])[k] for k in ("11", "0")]
    ran = lambda *rows: [(r["xid"] or of(r)[0], of(r)[1], r["commit_seq"], r["what"]) for r in tx.handleInputRows((5,), iter([row(*x) for x in rows]), None)]
    assert ran((1, "A", "INSERT"), (2, "B", "INSERT"), (4, "B", "ROLLBACK"), (3, "A", "COMMIT"), (5, None, "DELETE"), (6, None, "COMMIT"), (9, "C", "COMMIT")) == [
        (None, 5, 6, "change"), (None, None, 6, "ended"), ("A", 1, 3, "change"), ("A", None, 3, "ended"), ("B", None, 4, "ended"),
    ]
    assert calls == ["iterator"]
    many = [(k, "D", "INSERT") for k in range(20, 45)]
    assert ran((11, "A", "INSERT"), (12, "B", "INSERT"), *reversed(many)) == [("A", None, None, "opened"), ("B", None, None, "opened"), ("D", None, None, "opened")]
    assert not tx.runs.held and sorted(tx.begins.held) == [("A",), ("B",), ("D",)]
    assert ran((51, "D", "INSERT"), (50, "B", "COMMIT")) == [("B", 12, 50, "change"), ("B", None, 50, "ended")]
    assert ran((60, "D", "COMMIT"), (61, "D", "INSERT"), (62, "D", "COMMIT"), (63, "A", "ROLLBACK")) == [("D", k, 60, "change") for k in (*range(20, 45), 51)] + [("D", None, 60, "ended"), ("D", 61, 62, "change"), ("D", None, 62, "ended"), ("A", None, 63, "ended")]
    assert not tx.begins.held and not tx.open.held


def test_a_packed_row_comes_back(spark):
    values = [(1, 2, datetime.datetime(2020, 1, 2, 3, 4, 5, 678901), "INSERT", 1, "S", "", None, 'a"\\\n\u00e9\u0001\U0001f600 <', "R", 0, None, None), (3, *[None] * 12)]
    rows = spark.createDataFrame(values, streaming.CHANGE)
    made = rows.select(streaming.packed().alias("row"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in streaming.PACKED[1:]])
    assert [tuple(r)[:13] for r in streaming.unpacked(made).orderBy("seq").collect()] == values
    assert streaming.unpacked(made).schema == streaming.TRACED


def test_a_value_is_typed_once(spark):
    """Not once for its JSON and again for each use of that."""
    images = "CAST(map('ID', '1', 'CUST', '2', 'PRIO', 'a\"b', 'PLACED', '2020-01-01 00:00:00') AS map<string,string>)"
    rows = spark.range(1).select(F.lit(1).alias("scn"), F.lit("SALES").alias("seg_owner"), F.lit("ORDERS").alias("table_name"), F.lit("APP").alias("username"), F.lit("T1").alias("xid"), F.current_timestamp().alias("timestamp"), F.lit("u").alias("op"), F.expr(images).alias("before"), F.expr(images).alias("image"))
    made = asof.made(rows, Config.of({"db.name": "db", "table.whitelist": "SALES.ORDERS"}), core._catalog(spark), "tidemark").select("_made.records")
    plan = made._jdf.queryExecution().analyzed().toString()
    assert plan.count("yyyy-MM-dd HH:mm:ss") <= 2  # of the old and the new image; 6 before
    assert '"before":{"ID":1,"CUST":2,"PRIO":"a\\"b","PLACED":"2020-01-01T00:00:00.000Z"}' in made.first()["records"][0]["value"]


def _log(spark, n: int, ids: int):
    """n transactions of two changes each, of so many ids in turn; each ends before its id comes again."""
    rows = spark.range(n).select(F.explode(F.expr(f"""array(
        named_struct('seq', id * 10 + 10, 'xid', concat('T', id % {ids}), 'op', 'INSERT', 'code', 1), named_struct('seq', id * 10 + 11, 'xid', concat('T', id % {ids}), 'op', 'DELETE', 'code', 2),
        named_struct('seq', id * 10 + 12, 'xid', concat('T', id % {ids}), 'op', IF(id % 3 = 1, 'ROLLBACK', 'COMMIT'), 'code', IF(id % 3 = 1, 36, 7)))""")).alias("r"))
    values = {"seq": "r.seq", "scn": "r.seq", "operation": "r.op", "operation_code": "r.code", "xid": "r.xid", "rollback": "0", "seg_owner": "'SALES'", "table_name": "'ORDERS'", "username": "'APP'", "sql_redo": "'x'", "csf": "0", "status": "0"}
    return rows.select(*[F.expr(values.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in LOG])


def test_changes_meet_their_ends_within_a_range_and_across(spark):
    """Few ids that are used again and again: no pairs of all changes and all ends of an id."""
    rows = _log(spark, 40_000, 3)  # six ranges of places
    met = transactions.with_terminator(rows)
    got = met.select("seq", "end_seq", "end_scn", "end_operation").agg(F.count("*"), F.expr("count_if(end_seq = seq div 10 * 10 + 2 AND end_scn = end_seq AND end_operation = IF((seq div 10 - 1) % 3 = 1, 'ROLLBACK', 'COMMIT'))")).first()
    assert tuple(got) == (80_000, 80_000)
    joins = re.findall(r"Join .*", met._jdf.queryExecution().optimizedPlan().toString())
    assert joins and all("_range" in x for x in joins)
    # an end that is ranges away, an id that is null, and a change after the last end
    some = [(5, "A", "INSERT"), (300_000, "A", "COMMIT"), (300_001, "A", "INSERT"), (7, None, "INSERT"), (9, None, "COMMIT"), (200_000, "B", "ROLLBACK"), (200_001, "B", "INSERT"), (900_000, "B", "COMMIT")]
    few = spark.createDataFrame([(seq, seq, xid, op) for seq, xid, op in some], "seq long, scn long, xid string, operation string")
    assert sorted((r["seq"], r["end_seq"]) for r in transactions.with_terminator(few).collect()) == [(5, 300_000), (7, None), (200_001, 900_000), (300_001, None)]
    assert [r["seq"] for r in transactions.unfinished(few, 0, 300_000).orderBy("seq").collect()] == [7, 200_001, 300_001, 900_000]


def test_a_log_is_read_once_and_its_statements_move_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    made = cdc.changes(_log(spark, 200, 50).mapInArrow(counted, LOG), Config.of({"db.name": "db", "table.whitelist": "SALES", "batch.size": 3}))
    assert made.count() == 266 and read.value == 600
    plan = made._jdf.queryExecution().executedPlan().toString()
    moves = [x for x in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", made._jdf.queryExecution().explainString(made._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))) if "sql_redo" in x]
    assert len(moves) == 1, plan


def test_quarters_are_of_one_number_of_files(spark, tmp_path):
    files = core._write_in_parts(spark, _log(spark, 1000, 50), str(tmp_path / "log"), range(2), 200)
    files_ = core._write_in_parts(spark, _log(spark, 1000, 50), str(tmp_path / "log"), range(2, 4), 200)
    assert files == files_ == 3 and len(list((tmp_path / "log").glob("*.parquet"))) == 12
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3000


def test_a_reassembled_text_moves_once(spark):
    """Statements that go on over one range of places, over many, and end at a range's last place; ids that interleave; a gap; a null id."""
    row = lambda seq, xid, text, csf: {"seq": seq, "scn": seq, "operation": "INSERT", "xid": xid, "sql_redo": text, "csf": csf, "row_id": f"R{seq}", "username": f"U{seq}"}
    some = [(1, "A", "a", 1), (2, "A", "b", 1), (3, "A", "c", 0), (4, "B", "d", 0), (6, "A", "e", 1), (7, "A", "f", 0)]
    some += [(k, "B", f"{k},", int(k < 30)) for k in range(10, 31)] + [(31, None, "g", 1), (32, None, "h", 0), (35, "A", "i", 1), (37, "A", "j", 0), (39, "A", "k", 1), (40, "B", "l", 0)]
    log = spark.createDataFrame([tuple(row(*x).get(f.name) for f in LOG) for x in some], LOG)
    want = [(1, "abc", "U3"), (4, "d", "U4"), (6, "ef", "U7"), (10, "".join(f"{k}," for k in range(10, 31)), "U30"), (31, "gh", "U32"), (35, "i", "U35"), (37, "j", "U37"), (39, "k", "U39"), (40, "l", "U40")]
    for bits in (1, 2, 3, 16):
        made = reassembly.reassemble(log, bits)
        assert sorted((r["seq"], r["sql_redo"], r["username"]) for r in made.collect()) == want
        assert {r["row_id"] for r in made.collect()} == {f"R{seq}" for seq, *_ in want}
    made = reassembly.reassemble(log)
    made.collect()
    plan = made._jdf.queryExecution().explainString(made._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    final = plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    texts = [k for k in re.findall(r"\bExchange \((\d+)\)", final) if "sql_redo" in re.search(rf"\n\({k}\) Exchange\nInput \[\d+\]: (.*)", plan)[1]]
    assert len(texts) == 1, plan


def test_shuffles_of_what_is_written_are_deleted(spark):
    files = lambda: int(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size())
    before = files()
    assert shared.written(spark.range(1000).repartition(3, "id"), "some").count() == 1000
    left = files()
    assert spark.range(1000).repartition(3, "id").write.format("noop").mode("overwrite").save() is None
    assert left - before <= files() - left  # what ``count`` leaves, none of the writing
