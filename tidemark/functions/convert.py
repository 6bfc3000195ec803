"""Typed values from the texts of a redo log.  All are Column expressions; under ANSI a bad text is an error.

``strict=False`` gives null instead, for pipelines that keep bad rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

#: Words that a default can't be resolved from.  Fixed values.
UNRESOLVABLE = ("SYSDATE", "SYSTIMESTAMP", "CURRENT_TIMESTAMP", "CURRENT_DATE", "LOCALTIMESTAMP")


def null_literal(text: Column) -> Column:
    """The text NULL is null, quoted or not."""
    return F.nullif(text, F.lit("NULL"))


def number(text: Column, kind: str | DataType, strict: bool = True) -> Column:
    """A tinyint, smallint, int, bigint, float or double of the whole text."""
    return text.cast(kind) if strict else text.try_cast(kind)


def fraction_digits(text: Column) -> Column:
    """The digits after the point that the number of a text needs, by its digits alone (0 or less for whole numbers)."""
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?\d+)\s*$", 1).try_cast("int"), F.lit(0))
    mantissa = F.regexp_extract(text, r"^\s*[+-]?([\d.]*)", 1)
    digits = F.replace(mantissa, F.lit("."))
    told = F.length(F.regexp_extract(mantissa, r"\.(\d*)$", 1))
    return F.when(F.rtrim(digits, F.lit("0")) == "", F.lit(0)).otherwise(told - exponent - (F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))))


def decimal(text: Column, precision: int, scale: int, strict: bool = True) -> Column:
    """A decimal of exactly this value: a text that would have to be rounded is an error.

    Digits are counted in the text, so this holds for 38 digits too, where no wider type could tell.
    """
    narrow = DecimalType(precision, scale)
    near = text.try_cast(narrow)
    point = F.instr(text, ".")
    # most texts tell by their length alone
    short = ~F.contains(F.lower(text), F.lit("e")) & ((point == 0) | (F.length(text) - point <= scale))
    fits = near.isNotNull() & (short | (fraction_digits(text) <= scale))
    bad = F.raise_error(F.concat(F.lit(f"no decimal({precision},{scale}): "), text)).cast(narrow) if strict else F.lit(None).cast(narrow)
    return F.when(text.isNull(), F.lit(None).cast(narrow)).when(fits, near).otherwise(bad)


def _fraction(digits: int) -> str:
    return f"[.{'S' * digits}]" if digits else ""


def date(text: Column, strict: bool = True) -> Column:
    """A date; a time of day is read and dropped."""
    parse = F.to_date if strict else lambda c, f: F.try_to_date(c, f)
    return parse(F.ltrim(text), "yyyy-MM-dd[ HH:mm:ss]")


def milliseconds(value: Column) -> Column:
    """A timestamp with what is finer than milliseconds cut off."""
    return F.date_trunc("MILLISECOND", value)


def timestamp(text: Column, zone: str, digits: int = 6) -> Column:
    """The instant of a wall clock in ``zone`` (session time zone UTC); in gaps later, in overlaps the earlier offset."""
    wall = F.to_timestamp_ntz(F.ltrim(text), F.lit(f"yyyy-MM-dd HH:mm:ss{_fraction(digits)}"))
    return milliseconds(F.to_utc_timestamp(wall, zone))


def timestamp_region(text: Column, digits: int = 6) -> Column:
    """The instant of a text like ``2020-01-27 06:00:00.640000 US/Pacific PDT``."""
    return milliseconds(F.to_timestamp(F.ltrim(text), f"yyyy-MM-dd HH:mm:ss{_fraction(digits)} VV [zzz]"))


def timestamp_offset(text: Column, digits: int = 6) -> Column:
    """The instant of a text like ``2020-09-24 10:11:26.684000+00:00``."""
    return milliseconds(F.to_timestamp(F.ltrim(text), f"yyyy-MM-dd HH:mm:ss{_fraction(digits)}xxx"))


def default_string(text: Column) -> Column:
    """A column's default as a string: blanks go, then quotes around it."""
    return F.regexp_replace(F.trim(text), r"(?s)^'(.*)'$", "$1")


def default_number(text: Column, kind: str | DataType) -> Column:
    """A column's default as a number, null if it is an expression."""
    return F.trim(text).try_cast(kind)


def _resolvable(text: Column) -> Column:
    return ~F.coalesce(F.upper(text).rlike("|".join(UNRESOLVABLE)), F.lit(False))


def default_date(text: Column) -> Column:
    inner = F.regexp_replace(F.upper(F.trim(text)), "^DATE '(.*)'$", "$1")
    return F.when(_resolvable(text), F.try_to_date(inner, "yyyy-MM-dd[ HH:mm:ss]"))


def default_timestamp(text: Column, zone: str, digits: int = 6) -> Column:
    inner = F.regexp_replace(F.upper(F.trim(text)), "^TIMESTAMP '(.*)'$", "$1")
    wall = F.try_to_timestamp(inner, F.lit(f"yyyy-MM-dd HH:mm:ss{_fraction(digits)}")).cast("timestamp_ntz")
    return F.when(_resolvable(text), milliseconds(F.to_utc_timestamp(wall, zone)))
