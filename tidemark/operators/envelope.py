"""Change envelopes: source block, key, before and after, tombstones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import types
from tidemark.functions.names import topic_name
from tidemark.operators.parse import after_image
from tidemark.schema import DELETE, INSERT, OPS, UPDATE, VERSION


def op_letter(operation: Column) -> Column:
    """The letter of an operation's name; another name is an error."""
    known = F.lit(None).cast("string")
    for name, letter in OPS.items():
        known = F.when(operation == name, letter).otherwise(known)
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown operation: "), operation)).cast("string"))


def op_code(operation: Column) -> Column:
    return F.when(operation == "INSERT", INSERT).when(operation == "UPDATE", UPDATE).when(operation == "DELETE", DELETE)


def source_struct(connector: str, ts: Column, tx: Column, scn: Column, owner: Column, table: Column, user: Column) -> Column:
    return F.struct(
        F.lit(VERSION).alias("version"), F.lit(connector).alias("connector"), ts.alias("ts_ms"), tx.alias("txId"), scn.alias("scn"),
        owner.alias("schema"), table.alias("table"), user.alias("user"),
    )


#: How the error begins that a column unknown to the schema raises.
UNKNOWN = "unknown column"


def typed_struct(image: Column, schema: StructType, zone: str, strict: bool = True) -> Column:
    """A map of texts as a typed row; absent columns are null, an absent image is a null row.

    A column that the schema lacks is an error, as its value would be lost: the table has changed (see ``plans.cdc``).  If not
    ``strict``, that is for the caller to see to.
    """
    lacking = unknown_columns(image, schema)
    row = F.struct(*[types.typed(image[f.name], f, zone).alias(f.name) for f in schema])
    if not strict:
        return F.when(image.isNotNull(), row)
    error = F.raise_error(F.concat(F.lit(f"{UNKNOWN} of this schema: "), F.array_join(lacking, ", "))).cast(StructType([*schema.fields]))
    return F.when(image.isNull(), F.lit(None)).when(F.size(lacking) > 0, error).otherwise(row)


def unknown_columns(image: Column, schema: StructType) -> Column:
    """The columns of an image that the schema lacks: the table has changed, and its catalog must be read again."""
    return F.array_except(F.map_keys(image), F.array(*[F.lit(f.name) for f in schema]) if len(schema) else F.array().cast("array<string>"))


def key_struct(op: Column, before: Column, after: Column, key: StructType | None) -> Column:
    """The primary key: of the new row when it is read or inserted, of the old one when it is updated or deleted."""
    if key is None:
        return F.lit(None)
    image = F.when(op.isin("r", "i"), after).otherwise(before)
    return F.struct(*[image[f.name].alias(f.name) for f in key])


def envelopes(changes: DataFrame, value: StructType, key: StructType | None, db: str, connector: str, zone: str = "UTC") -> DataFrame:
    """Parsed changes of one table as topic, key, value (op, before, after, source, ts_ms) and what ``changes`` has for an offset."""
    rows = changes.withColumn("image", after_image(op_code(F.col("operation")), F.col("before"), F.col("after"))).withColumn("op", op_letter(F.col("operation")))
    rows = rows.withColumn("old", typed_struct(F.col("before"), value, zone)).withColumn("new", typed_struct(F.col("image"), value, zone))
    source = source_struct(connector, F.col("timestamp"), F.col("xid"), F.col("scn"), F.col("seg_owner"), F.col("table_name"), F.col("username"))
    whole = F.struct("op", F.col("old").alias("before"), F.col("new").alias("after"), source.alias("source"), F.current_timestamp().alias("ts_ms"))
    rest = [c for c in ("offset", "commit_seq", "seq") if c in changes.columns]
    return rows.select(topic_name(db, F.col("seg_owner"), F.col("table_name")).alias("topic"), key_struct(F.col("op"), F.col("old"), F.col("new"), key).alias("key"), whole.alias("value"), *rest)


#: The type of ``texts``.
TEXTS = "array<struct<topic:string,key:string,value:string,part:int>>"


def texts(value: StructType, key: StructType | None, db: str, connector: str, zone: str = "UTC", tombstones: bool = True, strict: bool = True) -> Column:
    """The records (topic, key and value as JSON, part) of a parsed change that has ``op`` and ``image``: none for an insert that
    lacks a required column, and after a delete a tombstone."""
    raw = F.when(F.col("op").isin("r", "i"), F.col("image")).otherwise(F.col("before"))
    source = source_struct(connector, F.col("timestamp"), F.col("xid"), F.col("scn"), F.col("seg_owner"), F.col("table_name"), F.col("username"))
    row = F.to_json(F.struct(F.col("op"), typed_struct(F.col("before"), value, zone, strict).alias("before"), typed_struct(F.col("image"), value, zone, strict).alias("after"), source.alias("source"), F.current_timestamp().alias("ts_ms")))
    keys = F.lit(None).cast("string") if key is None else F.to_json(F.struct(*[types.typed(raw[f.name], f, zone).alias(f.name) for f in key]))
    topic, lacks = topic_name(db, F.col("seg_owner"), F.col("table_name")), F.lit(False)
    for f in value:
        if not f.nullable:
            lacks = lacks | types.typed(F.col("image")[f.name], f, zone).isNull()
    record = lambda text, part: F.struct(topic.alias("topic"), keys.alias("key"), text.alias("value"), F.lit(part).alias("part"))
    after = F.when((F.col("op") == "d") & F.lit(tombstones), record(F.lit(None).cast("string"), 1))
    return F.when(~(F.col("op").isin("r", "i") & F.col("image").isNotNull() & lacks), F.array_compact(F.array(record(row, 0), after)))


def missing_required(image: Column, value: StructType) -> Column:
    """Whether a row lacks a column that can't be null."""
    out = F.lit(False)
    for f in value:
        if not f.nullable:
            out = out | image[f.name].isNull()
    return image.isNotNull() & out


def split_invalid(records: DataFrame, value: StructType) -> tuple[DataFrame, DataFrame]:
    """(records to send, records kept apart): an image of an insert or snapshot must have all required columns."""
    bad = missing_required(F.col("value.after"), value) & F.col("value.op").isin("i", "r")
    return records.where(~bad), records.where(bad)


def with_tombstones(records: DataFrame, wanted: bool = True) -> DataFrame:
    """After each delete a record with the same key and a null value; ``part`` is 0 for records, 1 for these."""
    parts = F.when((F.col("value.op") == "d") & F.lit(wanted), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = records.withColumn("part", F.explode(parts))
    return rows.withColumn("value", F.when(F.col("part") == 0, F.col("value")))
