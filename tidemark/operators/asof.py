"""Typing of changes by a join with the catalog: each change meets the columns that its table had at its SCN.

The catalog's columns become one row for each table and version, with the columns as an array and the SCNs for which they hold.  A change joins it by table and
SCN, and its images are walked column by column: the text of a column becomes the JSON of its type.  There is a branch for each *type* that the catalog has, and not
for each table and version, so plans and code stay small however many tables there are.  The join has no hint: Spark
broadcasts the tables while they are small, and beyond that splits a table that has most of the changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from tidemark.config import Config
from tidemark.functions import types
from tidemark.functions.names import topic_name
from tidemark.operators import envelope
from tidemark.operators.scan import selected
from tidemark.sources.catalog import Catalog


#: Columns of a catalog, of all versions together, up to which it is broadcast.
SMALL = 200_000


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    # an element_at knows its type; a get asks all expressions below for theirs again for each row
    return F.try_element_at(F.transform(F.array(value), then), F.lit(1))


def _fragment(value: Column, kind: str = "") -> Column:
    """A value as JSON; null if it is null.  Whole numbers, and strings (of this ``kind``) without a sign to be escaped, are their texts."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("string")
    made = lambda v: _let(F.to_json(F.struct(v.alias("v"))), lambda whole: F.when(whole != "{}", F.substr(whole, F.lit(6), F.length(whole) - 6)))
    if kind != "string":
        return made(value)
    return _let(value, lambda v: F.when(v.rlike(r"\A[ !#-\[\]-~]*+\z"), F.concat(F.lit('"'), v, F.lit('"'))).otherwise(made(v)))


def tables(catalog: Catalog, config: Config, strict: bool = True) -> tuple[DataFrame, list[StructField]]:
    """(rows of owner, table, from_scn, until_scn and columns; the types that columns refer to by number) of the selected tables.

    The first version holds for what is older, too.  A type that is not supported is an error, and if ``strict`` so is a table that is selected by name and that
    the catalog lacks.
    """
    own = catalog.columns.where(selected(config.selectors, "owner", "table_name"))
    named = {(s.owner, s.table) for s in config.selectors if s.table is not None} if strict else set()
    if named and (lacking := named - {tuple(r) for r in own.select("owner", "table_name").distinct().collect()}):
        raise LookupError(f"the catalog has no columns of {sorted(lacking)}")
    table = Window.partitionBy("owner", "table_name")
    if "from_scn" not in own.columns:
        own = own.withColumn("from_scn", F.lit(None).cast("long"))
    if config["db.dictionary"] != "REDO_LOG":  # the latest
        own = own.withColumn("_last", F.max("from_scn").over(table)).where(F.col("from_scn").eqNullSafe(F.col("_last"))).drop("_last")
    key = ["data_type", "data_precision", "data_scale"]
    number: dict[tuple, int] = {}
    found: list[StructField] = []
    rows = []
    for r in own.select(*key).distinct().collect():  # the types of a catalog
        f = types.field({"column_name": "v", "nullable": "Y"} | r.asDict(), catalog.free_scale)
        same = (f.dataType.simpleString(), f.metadata["catalog_type"] if f.dataType.typeName() == "timestamp" else "", f.metadata["catalog_scale"] if f.dataType.typeName() == "timestamp" else None)
        if same not in number:
            number[same] = len(found)
            found.append(f)
        rows.append((*r, number[same]))
    of = catalog.columns.sparkSession.createDataFrame(rows, ", ".join(f"_{c} {own.schema[c].dataType.simpleString()}" for c in key) + ", type_no int")
    typed = own.join(of, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    in_key = F.coalesce(F.col("in_key"), F.lit(False)) if "in_key" in own.columns else F.lit(False)
    column = F.struct("column_id", F.col("column_name").alias("name"), _fragment(F.col("column_name")).alias("label"), "type_no", (F.col("nullable") == "Y").alias("nullable"), in_key.alias("in_key"))
    out = typed.groupBy("owner", "table_name", "from_scn").agg(F.sort_array(F.collect_list(column)).alias("columns"))
    order = table.orderBy("from_scn")
    first = F.row_number().over(order) == 1
    out = out.withColumn("until_scn", F.lead("from_scn").over(order)).withColumn("from_scn", F.when(~first, F.col("from_scn")))
    return F.broadcast(out) if own.count() <= SMALL else out, found


def _object(columns: Column, fragments: Column) -> Column:
    """The JSON of a row: its columns that are not null, in their order."""
    parts = F.zip_with(columns, fragments, lambda c, x: F.concat(c["label"], F.lit(":"), x))
    return F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ","), F.lit("}"))


def made(rows: DataFrame, config: Config, catalog: Catalog, connector: str, strict: bool = True) -> DataFrame:
    """Parsed changes (with ``op`` and ``image``) and ``_made``: struct<records, drift>, null for a table that is not there.

    Records are those of ``envelope.texts``.  ``drift``: a column is not the table's; if ``strict``, that is an error.
    """
    zone = config["db.timezone"]
    of, kinds = tables(catalog, config, strict)
    # a hint stays with the plan below a projection
    of = of.select(F.col("owner").alias("_owner"), F.col("table_name").alias("_table"), F.col("from_scn").alias("_from"), F.col("until_scn").alias("_until"), F.col("columns").alias("_columns"))
    on = (F.col("seg_owner") == F.col("_owner")) & (F.col("table_name") == F.col("_table")) & (F.col("_from").isNull() | (F.col("scn") >= F.col("_from"))) & (F.col("_until").isNull() | (F.col("scn") < F.col("_until")))
    rows = rows.join(of, on, "left")
    columns = F.col("_columns")

    def fragments(image: Column) -> Column:
        def one(c: Column) -> Column:
            def typed(text: Column) -> Column:
                out = F.lit(None).cast("string")
                for k, f in enumerate(kinds):
                    out = F.when(c["type_no"] == k, _fragment(types.typed(text, f, zone), f.dataType.simpleString())).otherwise(out)
                return F.when(text.isNotNull(), out)

            return _let(F.try_element_at(image, c["name"]), typed)

        return F.transform(columns, one)

    lacking = lambda image: F.array_except(F.map_keys(image), F.transform(columns, lambda c: c["name"]))
    unknown = F.concat(*[F.coalesce(lacking(F.col(x)), F.array().cast("array<string>")) for x in ("before", "image")])
    topic = topic_name(config["db.name"], F.col("seg_owner"), F.col("table_name"))
    source = F.to_json(envelope.source_struct(connector, F.col("timestamp"), F.col("xid"), F.col("scn"), F.col("seg_owner"), F.col("table_name"), F.col("username")))
    fresh = F.col("op").isin("r", "i")

    def records(old: Column, new: Column) -> Column:
        """Of the fragments of both images (null: no image)."""
        text = F.concat(
            F.lit('{"op":"'), F.col("op"), F.lit('"'), F.coalesce(F.concat(F.lit(',"before":'), _object(columns, old)), F.lit("")), F.coalesce(F.concat(F.lit(',"after":'), _object(columns, new)), F.lit("")),
            F.lit(',"source":'), source, F.lit(',"ts_ms":'), _fragment(F.current_timestamp()), F.lit("}"),
        )
        keys = F.filter(F.zip_with(columns, F.when(fresh, new).otherwise(old), lambda c, x: F.when(c["in_key"], F.struct(c["label"].alias("label"), x.alias("x")))), lambda x: x.isNotNull())
        keyed = F.when(F.exists(columns, lambda c: c["in_key"]), F.concat(F.lit("{"), F.array_join(F.array_compact(F.transform(F.coalesce(keys, F.array()), lambda x: F.concat(x["label"], F.lit(":"), x["x"]))), ","), F.lit("}")))
        lacks = F.exists(F.zip_with(columns, new, lambda c, x: ~c["nullable"] & x.isNull()), lambda x: x)

        def both(head: Column) -> Column:
            record = lambda value, part: F.struct(head["topic"].alias("topic"), head["key"].alias("key"), value.alias("value"), F.lit(part).alias("part"))
            tombstone = record(F.lit(None).cast("string"), 1)
            return F.when((F.col("op") == "d") & F.lit(config["tombstones.on.delete"]), F.array(record(text, 0), tombstone)).otherwise(F.array(record(text, 0)))

        return F.when(~(fresh & new.isNotNull() & F.coalesce(lacks, F.lit(False))), _let(F.struct(topic.alias("topic"), keyed.alias("key")), both))

    pair = F.struct(F.when(F.col("before").isNotNull(), fragments(F.col("before"))).alias("old"), F.when(F.col("image").isNotNull(), fragments(F.col("image"))).alias("new"))
    built = _let(pair, lambda p: records(p["old"], p["new"])).cast(envelope.TEXTS)

    def out(unknown: Column) -> Column:
        error = F.raise_error(F.concat(F.lit(f"{envelope.UNKNOWN} of this schema: "), F.array_join(unknown, ", "))).cast(envelope.TEXTS)
        drift = F.size(unknown) > 0
        return F.struct(F.when(drift, error if strict else F.lit(None).cast(envelope.TEXTS)).otherwise(built).alias("records"), drift.alias("drift"))

    return rows.withColumn("_made", F.when(columns.isNotNull(), _let(unknown, out))).drop("_owner", "_table", "_from", "_until", "_columns")
