"""Snapshots as of the log's SCN have the whole table, at every size."""

import duckdb
import pytest

from tidemark.plans import queries as core


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_snapshots_grow(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{sf}/orders.parquet'")
    n, after = con.execute("SELECT count(*), count(*) FILTER (o_orderkey > 250) FROM orders").fetchone()
    for name, want in (("snapshot_read", n), ("snapshot_envelope", n), ("snapshot_resume", after)):
        assert core.QUERIES[name](spark, sf).count() == want
    got = {r["part"]: r["count"] for r in core.QUERIES["snapshot_then_cdc"](spark, sf).groupBy("part").count().collect()}
    want = dict(con.execute(f"SELECT part, count(*) FROM ({core.ORACLES['snapshot_then_cdc']}) GROUP BY part").fetchall())
    print(sf, n, after, got)
    assert got == want and got["snapshot"] > n / 4
