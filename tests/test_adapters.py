"""Reading a database by JDBC: the one that Spark ships stands for others."""

import time

import pytest
from pyspark.sql import functions as F

from test_job import columns, config, known
from tidemark.plans import cdc, ledger
from tidemark.sources import adapters, snapshot

URL = "jdbc:derby:memory:tidemark;create=true"
DATABASE = {"db.hostname": "h", "db.port": 1, "db.sid": "s", "db.user": "app", "db.user.password": "secret", "db.attempts": 3, "db.backoff.ms": 50}


@pytest.fixture
def table(spark):
    rows = spark.range(100).selectExpr("CAST(id AS INT) AS ID", "concat('a', id) AS A", "format_string('R%05d', id) AS ROW_ID", "id AS ROW_SCN")
    rows.write.format("jdbc").options(url=URL, dbtable="T", user="app", password="secret").mode("overwrite").option("createTableColumnTypes", "A VARCHAR(20), ROW_ID VARCHAR(20)").save()


def test_a_snapshot_of_a_database(spark, table, tmp_path):
    """Ranges reach the database as conditions of its queries, and each row is delivered once, over two calls."""
    one, path = config(**DATABASE), str(tmp_path / "out")

    def tables(owner, name, scn):
        return adapters.jdbc(spark, one, f'SELECT ID, A, ROW_ID AS "row_id", ROW_SCN AS "row_scn" FROM {name} WHERE ROW_SCN <= {scn}', URL)

    part = snapshot.between(tables("S", "T", 79), "R00009", "R00019")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "row_id" in plan.split("PushedFilters")[1] and "R00009" in plan.split("PushedFilters")[1]
    assert sorted(r["ID"] for r in part.collect()) == list(range(10, 20))
    for _ in range(2):
        cdc.write_snapshot(tables, 79, one, known(spark, columns()), path, 30, None if ledger.listed(spark, path) else 1)
    got = ledger.read(spark, path).select("batch", F.get_json_object("value", "$.after.ID").cast("int").alias("id")).collect()
    assert sorted(r["id"] for r in got) == list(range(80)) and len({r["batch"] for r in got}) >= 2
    assert cdc.begin(spark, one, path)["scn"] == 79


def test_connecting_is_tried_again(spark, table):
    began = time.time()
    with pytest.raises(Exception, match="(?i)database|connect"):
        adapters.jdbc(spark, config(**DATABASE), "SELECT ID FROM T", "jdbc:derby:memory:missing")
    assert time.time() - began >= 0.1  # two waits
    assert not adapters.is_valid(spark, config(**DATABASE))
    with pytest.raises(ValueError, match="connection must be set"):
        adapters.jdbc(spark, config(), "SELECT ID FROM T", URL)
