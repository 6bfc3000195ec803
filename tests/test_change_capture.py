"""Each query against its SQL, and statements and settings one by one."""

import datetime

import duckdb
import pytest

from tidemark.config import Config, Selector
from tidemark.operators import reassembly
from tidemark.plans import queries as core

SF = "/root/testdata/sf0.001"
TABLES = ("orders", "customer", "nation", "part", "events")


def value(x):
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return repr(round(float(x), 6))
    return x.isoformat() if isinstance(x, (datetime.date, datetime.datetime)) else repr(x)


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(value(r[k]) for k in order) for r in found)


@pytest.mark.parametrize("name", list(core.ORACLES))
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(core.ORACLES[name])
    got = core.QUERIES[name](spark, SF)
    assert rows(got.columns, got.collect()) == rows([d[0] for d in want.description], want.fetchall())


def test_pieces_of_a_statement(spark):
    from tidemark.schema import LOG

    row = lambda seq, sql, csf: (seq, seq, None, "INSERT", 1, 0, "S", "T", "APP", sql, f"R{seq}", csf, "X", 0)
    log = spark.createDataFrame([row(1, "ab", 1), row(2, "cd", 1), row(3, "e", 0), row(4, "whole", 0), row(5, None, 0)], LOG)
    got = reassembly.reassemble(log).orderBy("seq").collect()
    assert [(r["seq"], r["sql_redo"]) for r in got] == [(1, "abcde"), (4, "whole"), (5, None)]


def test_settings():
    c = Config.of({"db.name": "shop", "table.whitelist": "A.T, B"})
    assert c.selectors == [Selector("A", "T"), Selector("B")] and c["db.fetch.size"] == c["batch.size"] == 1000
    for bad in ({"db.name": "x"}, {"db.name": "", "table.whitelist": "A"}, {"db.name": "x", "table.whitelist": "A", "db.dictionary": "NO"}):
        with pytest.raises(ValueError):
            Config.of(bad)
    with pytest.warns(UserWarning, match="other"):
        Config.of({"db.name": "x", "table.whitelist": "A", "other": 1, "name": "job", "tasks.max": "1"})
    assert Config.of({"db.name": "x", "table.whitelist": "A", "db.any.dictionary": "REDO_LOG"})["db.dictionary"] == "REDO_LOG"
    with pytest.raises(ValueError, match="db.sid"):
        c.for_database()


def test_settings_file(tmp_path):
    at = tmp_path / "job.properties"
    at.write_text("# a job\nname=job\nstart.scn=0\ndb.name=shop\ndb.sid=XE\ndb.hostname=127.0.0.1\ndb.port=1521\t\ndb.user=u\ndb.user.password=p=q\n\nbatch.size=10\ntable.whitelist=A.T, B")
    c = Config.read(str(at)).for_database()
    assert (c["db.port"], c["db.user.password"], c["batch.size"], c["db.fetch.size"], c.selectors) == (1521, "p=q", 10, 10, [Selector("A", "T"), Selector("B")])
