"""Column types: from catalog rows to engine types, as a query and as schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType, TimestampType,
)

from tidemark.functions import convert

#: Types of the catalog that are texts.  Fixed values.
TEXTS = ("CHAR", "VARCHAR", "VARCHAR2", "NVARCHAR2", "CLOB", "NCLOB", "LONG", "NCHAR")
#: Scale of numbers without one: a decimal of 38 digits has to do for 79 with 40 after the point.  A number that needs more
#: is an error, never rounded; None as the scale keeps such columns as texts, which lose nothing.
FREE_SCALE = 20


class UnsupportedTypeError(ValueError):
    pass


def scale_or_null(scale: Column, precision: Column) -> Column:
    """A scale of 0 with a precision of 0 is no scale."""
    return F.when(scale.isNotNull() & ~((scale == 0) & (F.coalesce(precision, F.lit(0)) == 0)), scale)


def type_name(kind: Column, precision: Column, scale: Column, free_scale: int | None = FREE_SCALE) -> Column:
    """The engine type of a catalog column, as text; null if it is not supported.  ``scale``: after ``scale_or_null``."""
    p = F.coalesce(precision, F.lit(0))
    whole = F.when(p > 9, "bigint").when(p > 4, "int").when(p > 2, "smallint").otherwise("tinyint")
    wide = F.concat(F.lit("decimal("), F.least(F.greatest(p - F.least(scale, F.lit(0)), p), F.lit(38)), F.lit(","), F.greatest(scale, F.lit(0)), F.lit(")"))
    number = (
        F.when(scale.isNull(), "string" if free_scale is None else f"decimal(38,{free_scale})")
        .when((p < 19) & scale.between(-84, 0), whole)
        .when((p < 19) & (p > 0), "double")
        .when(p < 19, F.concat(F.lit("decimal(38,"), scale, F.lit(")")))
        .otherwise(wide)
    )
    return (
        F.when(kind == "BINARY_FLOAT", "float").when(kind == "BINARY_DOUBLE", "double").when(kind == "NUMBER", number)
        .when(kind.isin(*TEXTS), "string").when(kind == "DATE", "date").when(kind.startswith("TIMESTAMP"), "timestamp")
    )


def data_type(kind: str, precision: int | None, scale: int | None, free_scale: int | None = FREE_SCALE) -> DataType:
    """The same for one column, on the driver (a test holds one against the other)."""
    p = precision or 0
    if scale == 0 and p == 0:
        scale = None
    if kind == "NUMBER":
        if scale is None:
            return StringType() if free_scale is None else DecimalType(38, free_scale)
        if p < 19 and -84 <= scale <= 0:
            return LongType() if p > 9 else IntegerType() if p > 4 else ShortType() if p > 2 else ByteType()
        if p < 19:
            return DoubleType() if p > 0 else DecimalType(38, min(scale, 38))
        return DecimalType(min(max(p - min(scale, 0), p), 38), max(scale, 0))
    if kind in TEXTS:
        return StringType()
    known = {"BINARY_FLOAT": FloatType(), "BINARY_DOUBLE": DoubleType(), "DATE": DateType()}
    if kind in known:
        return known[kind]
    if kind.startswith("TIMESTAMP"):
        return TimestampType()
    raise UnsupportedTypeError(f"columns of type {kind} are not supported")


def field(column: dict, free_scale: int | None = FREE_SCALE) -> StructField:
    """A field of a catalog row (column_name, data_type, data_precision, data_scale, nullable, comments, data_default)."""
    meta = {"catalog_type": column["data_type"], "catalog_scale": column.get("data_scale")}
    if isinstance(kind := data_type(column["data_type"], column.get("data_precision"), column.get("data_scale"), free_scale), DecimalType):
        meta["decimal_precision"] = kind.precision
    meta |= {k: column[c] for k, c in (("comment", "comments"), ("default", "data_default")) if column.get(c) is not None}
    return StructField(column["column_name"], kind, column["nullable"] == "Y", meta)


def row_schemas(columns: list[dict], keys: set[str], free_scale: int | None = FREE_SCALE) -> tuple[StructType, StructType | None]:
    """(value, key) schemas of a table; a table without a primary key has a null key."""
    fields = [field(c, free_scale) for c in sorted(columns, key=lambda c: c["column_id"])]
    key = [f for f in fields if f.name in keys]
    return StructType(fields), StructType(key) if key else None


def typed(text: Column, f: StructField, zone: str) -> Column:
    """A raw text as a value of the field's type."""
    text, kind, digits = convert.null_literal(text), f.metadata.get("catalog_type", ""), f.metadata.get("catalog_scale")
    digits = 6 if digits is None or digits == 0 else digits
    if f.dataType.typeName() == "date":
        return convert.date(text)
    if f.dataType.typeName() == "timestamp":
        if kind.endswith("WITH LOCAL TIME ZONE"):
            return convert.timestamp_offset(text, digits)
        return convert.timestamp_region(text, digits) if kind.endswith("WITH TIME ZONE") else convert.timestamp(text, zone, digits)
    if isinstance(f.dataType, DecimalType):
        return convert.decimal(text, f.dataType.precision, f.dataType.scale)
    return text if isinstance(f.dataType, StringType) else convert.number(text, f.dataType)


def default_value(f: StructField, zone: str) -> Column | None:
    """The field's default, or None where it has none: a field that can't be null keeps only a default that resolves."""
    if (text := f.metadata.get("default")) is None:
        return F.lit(None).cast(f.dataType) if f.nullable else None
    text = F.lit(text)
    kind = f.dataType.typeName()
    if kind == "date":
        return convert.default_date(text)
    if kind == "timestamp":
        return convert.default_timestamp(text, zone)
    return convert.default_string(text) if kind == "string" else convert.default_number(text, f.dataType)
