"""Which rows of a redo log are read: control rows of transactions, and changes of selected tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Selector
from tidemark.schema import COMMIT, DELETE, INSERT, INTERNAL_USERS, LOG_COLUMNS, ROLLBACK, TEMPORARY, UNREADABLE, UPDATE


def selected(selectors: list[Selector], owner: str = "seg_owner", table: str = "table_name") -> Column:
    """Whether a row's table is one of those selected, by owner and table or by owner; letters' case counts."""
    one = lambda s: F.col(owner) == s.owner if s.table is None else (F.col(owner) == s.owner) & (F.col(table) == s.table)
    return reduce(or_, map(one, selectors))


def is_control(from_scn: int) -> Column:
    """Commits and rollbacks from an SCN on, but for internal users'; a null user is dropped, too (three-valued logic)."""
    return (F.col("scn") >= from_scn) & F.col("operation_code").isin(COMMIT, ROLLBACK) & ~F.col("username").isin(*INTERNAL_USERS)


def is_change(from_scn: int, selectors: list[Selector]) -> Column:
    return (F.col("scn") >= from_scn) & F.col("operation_code").isin(INSERT, DELETE, UPDATE) & selected(selectors)


def control_rows(log: DataFrame, from_scn: int = 0) -> DataFrame:
    return log.where((F.col("rollback") == 0) & is_control(from_scn)).select(*LOG_COLUMNS)


def change_rows(log: DataFrame, selectors: list[Selector], from_scn: int = 0) -> DataFrame:
    return log.where((F.col("rollback") == 0) & is_change(from_scn, selectors)).select(*LOG_COLUMNS)


def scan(log: DataFrame, selectors: list[Selector], change_from: int = 0, control_from: int = 0) -> DataFrame:
    """Both kinds of rows in one pass over the log; all predicates reach the reader, and the lower bound of both chooses files."""
    return log.where((F.col("scn") >= min(change_from, control_from)) & (F.col("rollback") == 0) & (is_control(control_from) | is_change(change_from, selectors))).select(*LOG_COLUMNS)


def bounds(scn: int, commit_scn: int, complete: bool) -> tuple[int, int]:
    """(first SCN of changes, first SCN of control rows) after a durable offset."""
    return (scn + 1 if complete and commit_scn == scn else scn), (commit_scn + 1 if complete else commit_scn)


def resume(log: DataFrame, selectors: list[Selector], scn: int, commit_scn: int, complete: bool) -> DataFrame:
    change_from, control_from = bounds(scn, commit_scn, complete)
    return scan(log, selectors, change_from, control_from)


def after_row(log: DataFrame, seq: int) -> DataFrame:
    """The rows after one that was read, by the exact order of the log."""
    return log.where(F.col("seq") > seq)


def gap(log: DataFrame, expected_scn: int) -> DataFrame:
    """One row: the first SCN at or after the expected one, and whether rows may be missing between."""
    return log.where(F.col("scn") >= expected_scn).agg(F.min("scn").alias("first_scn")).withColumn("gap", F.col("first_scn") > expected_scn)


def not_temporary() -> Column:
    """Whether a row is no change of a temporary table; a statement that is null isn't one."""
    return F.coalesce(F.col("operation").isin("COMMIT", "ROLLBACK"), F.lit(False)) | ~F.coalesce(F.col("sql_redo").contains(TEMPORARY), F.lit(False))


def drop_temporary(rows: DataFrame) -> DataFrame:
    """Without changes of temporary tables; a statement that is null stays."""
    return rows.where(not_temporary())


def drop_unreadable(rows: DataFrame) -> DataFrame:
    """Without changes that the log could not read; the end of a transaction counts whatever its status."""
    return rows.where(F.col("operation").isin("COMMIT", "ROLLBACK") | (F.coalesce(F.col("status"), F.lit(0)) != UNREADABLE))
