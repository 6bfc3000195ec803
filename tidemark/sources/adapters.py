"""Adapters to databases and brokers.  Reading by JDBC is tested with the small database that Spark ships; the queries of the database
whose log is mined, and the broker, need drivers that this machine lacks.

``log_query`` calls a table function ``mined_log`` that the database's owner has to install: it starts a mining session over
the files, returns its rows numbered in their order (``seq``), and ends the session.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Config


def jdbc(spark: SparkSession, config: Config, query: str, url: str | None = None) -> DataFrame:
    """A query's rows; connecting is tried db.attempts times, db.backoff.ms apart.  ``url``: of another kind of database."""
    config = config.for_database()
    options = {
        "url": url or f"jdbc:oracle:thin:@{config['db.hostname']}:{config['db.port']}:{config['db.sid']}", "user": config["db.user"], "password": config["db.user.password"],
        "query": query, "fetchsize": str(config["db.fetch.size"]),
    }
    for attempt in range(1, config["db.attempts"] + 1):
        try:
            return spark.read.format("jdbc").options(**options).load()
        except Exception:
            if attempt == config["db.attempts"]:
                raise
            time.sleep(config["db.backoff.ms"] / 1000)
    raise ValueError("db.attempts must be 1 or more")


def is_valid(spark: SparkSession, config: Config, timeout_s: int = 1) -> bool:
    """Whether the database answers; each read opens its own connection, so nothing has to be opened again."""
    try:
        return jdbc(spark, Config(config.values | {"db.attempts": 1}), f"SELECT 1 AS one FROM DUAL /* within {timeout_s} s */").head() is not None
    except Exception:
        return False


def log_query(files: list[str], from_scn: int, strategy: str) -> str:
    """The log rows from an SCN on, out of a mining session that has the files; a session of its own for each query.

    ONLINE reads names by the database's catalog; REDO_LOG by the dictionary in the files, which follows changes of tables.
    """
    if strategy not in ("ONLINE", "REDO_LOG"):
        raise ValueError("db.dictionary must be ONLINE or REDO_LOG")
    how = "ONLINE_CATALOG" if strategy == "ONLINE" else "REDO_LOGS_DDL"
    names = ", ".join("'" + x.replace("'", "''") + "'" for x in files)
    columns = "seq, scn, timestamp, operation, operation_code, rollback, seg_owner, table_name, username, sql_redo, row_id, csf, xid, status"
    return f"SELECT {columns} FROM TABLE(mined_log(file_list({names}), {from_scn}, '{how}'))"


def snapshot_query(owner: str, table: str, scn: int, last_row_id: str | None = None, upto: str | None = None) -> str:
    """A table's rows as of an SCN, with row ids and versions, after a row id and up to another (None: all)."""
    bounds = [f"t.ROWID {sign} '{at}'" for sign, at in ((">", last_row_id), ("<=", upto)) if at]
    where = f" WHERE {' AND '.join(bounds)}" if bounds else ""
    return f'SELECT t.*, t.ROWID AS "row_id", t.ORA_ROWSCN AS "row_scn" FROM "{owner}"."{table}" AS OF SCN {scn} t{where}'


def snapshot_rows(spark: SparkSession, config: Config, owner: str, table: str, scn: int, ranges: list[tuple[str | None, str | None]]) -> DataFrame:
    """The rows of a table as of an SCN, with a query, and so a connection and a task, for each range of row ids (see ``snapshot.ranges``)."""
    return reduce(DataFrame.unionByName, [jdbc(spark, config, snapshot_query(owner, table, scn, *r)) for r in ranges])


def broker(records: DataFrame, servers: str, checkpoint: str | None = None):
    """Write topic, key and value as JSON; a stream if ``records`` is one."""
    out = records.select("topic", F.to_json("key").alias("key"), F.to_json("value").alias("value"))
    if records.isStreaming:
        return out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint).start()
    return out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def files(records: DataFrame, path: str) -> None:
    """Write records as Parquet, a folder for each topic."""
    records.write.mode("append").partitionBy("topic").parquet(path)
