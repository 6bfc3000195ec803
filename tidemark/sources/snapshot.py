"""Initial snapshots of tables, and the hand-over to the log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from tidemark.functions.convert import decimal, milliseconds
from tidemark.operators.envelope import source_struct
from tidemark.schema import NO_TRANSACTION


def as_of(rows: DataFrame, scn: int, version: str = "row_scn") -> DataFrame:
    """The rows that were there at an SCN, of a table whose versions carry theirs."""
    return rows.where(F.col(version) <= scn)


def after(rows: DataFrame, last: object | None, row_id: str = "row_id") -> DataFrame:
    """The rows after the last one that was read."""
    return between(rows, last, None, row_id)


def between(rows: DataFrame, last: object | None, upto: object | None, row_id: str = "row_id") -> DataFrame:
    """The rows after a row id and up to another; None: from the begin, to the end.  Ids may be given as texts."""
    kind = rows.schema[row_id].dataType
    rows = rows if last is None else rows.where(F.col(row_id) > F.lit(last).cast(kind))
    return rows if upto is None else rows.where(F.col(row_id) <= F.lit(upto).cast(kind))


def ranges(rows: DataFrame, size: int, row_id: str = "row_id") -> list[tuple[object | None, object | None]]:
    """Ranges of row ids, as (after, up to) in their order, that have about ``size`` rows each; None: open.

    Only row ids are read; Spark deals them to ranges by a sample of them, and their last ids come to the driver, one for ``size`` rows.
    """
    ids = rows.select(row_id)
    n = -(-ids.count() // size)
    if n < 2:
        return [(None, None)]
    last = ids.repartitionByRange(n, row_id).groupBy(F.spark_partition_id().alias("part")).agg(F.max(row_id).alias("last"))
    ends = [r["last"] for r in last.orderBy("last").collect()][:-1]
    return list(zip([None, *ends], [*ends, None]))


def page(rows: DataFrame, size: int, last: object | None = None, row_id: str = "row_id") -> DataFrame:
    """The next ``size`` rows by row id; a top-k, so nothing is sorted as a whole."""
    return after(rows, last, row_id).orderBy(row_id).limit(size)


def read(rows: DataFrame, owner: str, table: str, scn: int, connector: str, row_id: str = "row_id", version: str = "row_scn") -> DataFrame:
    """Snapshot records of one table: op r, before null, after (all other columns), source and offset."""
    data = [F.col(f"`{c}`") for c in rows.columns if c not in (row_id, version)]
    source = source_struct(
        connector, F.timestamp_millis(F.lit(0)), F.lit(NO_TRANSACTION), F.col(version), F.lit(owner), F.lit(table), F.lit(None).cast("string")
    )
    offset = F.struct(F.lit("select").alias("type"), F.lit(scn).cast("long").alias("scn"), F.lit(owner).alias("owner"), F.lit(table).alias("table"), F.col(row_id).cast("string").alias("rowId"))
    return rows.select(F.lit("r").alias("op"), F.lit(None).cast("string").alias("before"), F.struct(*data).alias("after"), source.alias("source"), offset.alias("offset"))


def extract(rows: DataFrame, value: StructType, zone: str) -> DataFrame:
    """A table's rows, as a database gives them, by the schema's types: dates are cut to the day, timestamps (without a zone)
    are wall clocks in ``zone``, cut to milliseconds; nulls stay null.  Columns that the schema lacks are an error."""
    own = {f.name for f in value}
    if lacking := [c for c in rows.columns if c not in own and c not in ("row_id", "row_scn")]:
        raise ValueError(f"columns that the schema lacks: {lacking}")
    return rows.select(*[_typed(rows, f, zone).alias(f.name) for f in value], *[c for c in ("row_id", "row_scn") if c in rows.columns])


def _typed(rows: DataFrame, f: StructField, zone: str) -> Column:
    if f.name not in rows.columns:
        raise ValueError(f"the rows have no column {f.name}")
    value, kind = F.col(f"`{f.name}`"), rows.schema[f.name].dataType.typeName()
    if f.dataType.typeName() == "date":
        return F.to_date(value)
    if f.dataType.typeName() == "timestamp":
        return milliseconds(F.to_utc_timestamp(value, zone) if kind == "timestamp_ntz" else value)
    if isinstance(f.dataType, DecimalType):
        return decimal(value.cast("string"), f.dataType.precision, f.dataType.scale)
    return value.cast(f.dataType)


def together(parts: list[DataFrame]) -> DataFrame:
    """Records of several tables, as texts of their rows, with the place of each table."""
    one = lambda k, p: p.withColumn("after", F.to_json("after")).withColumn("table_no", F.lit(k))
    return reduce(lambda a, b: a.unionByName(b), [one(k, p) for k, p in enumerate(parts)])


def current_scn(log: DataFrame) -> DataFrame:
    return log.agg(F.max("scn").alias("current_scn"))


def plan(offset: dict | None, start_scn: int = 0) -> tuple[str, dict | None]:
    """('log' or 'snapshot', offset to begin at): a stored offset decides, then start.scn, else a snapshot begins."""
    kind = (offset or {}).get("type")
    if kind == "cdc":
        return "log", offset
    if kind == "select":
        return "snapshot", offset
    return ("log", handover(None, start_scn)) if start_scn > 0 else ("snapshot", None)


def handover(snapshot_offset: dict | None, start_scn: int = 0) -> dict:
    """The log's offset after a snapshot: its SCN twice, not complete; without rows, start.scn."""
    scn = snapshot_offset["scn"] if snapshot_offset else start_scn
    return {"type": "cdc", "scn": scn, "commitScn": scn, "isTransactionComplete": False}
