"""Names of topics, records and tables."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of table names; the range from . to _ has the digits, capitals and some signs, but neither - nor $ or #.  Fixed value.
TABLE_NAME = r"^[\w.-_]+$"


def valid_table_name(name):
    """Whether a full table name is taken; of a string or a column."""
    return name.rlike(TABLE_NAME) if isinstance(name, Column) else bool(re.match(TABLE_NAME, name, re.ASCII))


def topic_name(db: str, owner: Column, table: Column) -> Column:
    """``db.owner.table`` with _ for what topics can't have."""
    return F.regexp_replace(F.concat_ws(".", F.lit(db), owner, table), "[^A-Za-z0-9._-]", "_")


def record_names(topic: Column) -> dict[str, Column]:
    return {kind: F.concat(topic, F.lit(f".{kind}")) for kind in ("Envelope", "Key", "Value")}


def record_name(table: Column) -> Column:
    """A table's name without _t at its end, in lower case but for the first letter."""
    low = F.regexp_replace(F.lower(table), "_t$", "")
    return F.concat(F.upper(F.substring(low, 1, 1)), F.substr(low, F.lit(2)))


def table_id(full_name: str) -> tuple[str, str]:
    """(owner, table) of ``owner.table``; further parts are ignored."""
    parts = full_name.split(".")
    if len(parts) < 2:
        raise ValueError(f"no owner in {full_name!r}")
    return parts[0], parts[1]
