"""The catalog: columns, comments and keys of tables, and their schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.config import Selector
from tidemark.functions import types
from tidemark.operators.scan import selected


def columns(cols: DataFrame, comments: DataFrame, keys: DataFrame, selectors: list[Selector] | None = None) -> DataFrame:
    """Columns with comments (left join on owner, table and column), type_name, normalised scale and whether they are in the key."""
    c = cols if selectors is None else cols.where(selected(selectors, "owner", "table_name"))
    c = c.join(comments, ["owner", "table_name", "column_name"], "left")
    k = keys.select("owner", "table_name", "column_name").distinct().withColumn("in_key", F.lit(True))
    c = c.join(k, ["owner", "table_name", "column_name"], "left").withColumn("in_key", F.coalesce("in_key", F.lit(False)))
    c = c.withColumn("data_scale", types.scale_or_null(F.col("data_scale"), F.col("data_precision")))
    return c.withColumn("type_name", types.type_name(F.col("data_type"), F.col("data_precision"), F.col("data_scale")))


def tables_of(cols: DataFrame, selectors: list[Selector]) -> list[tuple[str, str]]:
    """The tables that selectors name, in their order and with repeats; a schema gives its tables by name."""
    out: list[tuple[str, str]] = []
    for s in selectors:
        if s.table is not None:
            out.append((s.owner, s.table))
        else:  # one schema's tables: a list of names
            found = cols.where(F.col("owner") == s.owner).select("table_name").distinct().orderBy("table_name").collect()
            out += [(s.owner, r["table_name"]) for r in found]
    return out


class Catalog:
    """Schemas of tables as of the latest catalog, or as of an SCN if catalog rows carry ``from_scn``; read once a table.

    ``load`` reads the catalog (see ``columns``), now and at each refresh.
    """

    def __init__(self, load: Callable[[], DataFrame], free_scale: int | None = types.FREE_SCALE):
        self.load, self.free_scale = load, free_scale
        self.refresh()

    def refresh(self) -> None:
        """Read the catalog again: a table has changed."""
        self.columns = self.load()
        self.known: dict[tuple, tuple[StructType, StructType | None]] = {}

    def schemas(self, owner: str, table: str, scn: int | None = None) -> tuple[StructType, StructType | None]:
        """(value, key) schemas."""
        if (at := (owner, table, scn)) not in self.known:
            rows = self.columns.where((F.col("owner") == owner) & (F.col("table_name") == table))
            if "from_scn" in self.columns.columns:
                when = rows if scn is None else rows.where(F.col("from_scn") <= scn)
                rows = rows.join(when.agg(F.max("from_scn").alias("from_scn")), "from_scn", "left_semi")
            got = [r.asDict() for r in rows.collect()]  # one table's columns
            if not got:
                raise LookupError(f"the catalog has no columns of {owner}.{table}")
            self.known[at] = types.row_schemas(got, {r["column_name"] for r in got if r.get("in_key")}, self.free_scale)
        return self.known[at]

    def versions(self, owner: str, table: str) -> list[int | None]:
        """The SCNs from which the table's versions hold, ascending; [None] if the catalog has the latest only."""
        if "from_scn" not in self.columns.columns:
            return [None]
        rows = self.columns.where((F.col("owner") == owner) & (F.col("table_name") == table))
        return [r["from_scn"] for r in rows.select("from_scn").distinct().orderBy("from_scn").collect()]  # one table's versions
