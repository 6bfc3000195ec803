"""What a job has delivered: batches of records, listed after they are written.

A path has a folder for each batch, ``batch=n`` with n in ten digits, so that the names are in order; rejected changes lie under
``_rejected``, and what is open after a batch under ``_open``.  The list is a file for each finished batch in ``_ledger``, written last and as a
whole: its source, counts, and the offset to go on from.  Readers see listed batches only; a batch that was broken off is written
again under its number.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tidemark import shared


def folder(path: str, n: int, kind: str = "") -> str:
    """Where a batch's records are, or its rows of another ``kind`` (_rejected, _open)."""
    return f"{path}/{kind}{'/' if kind else ''}batch={n:010d}"


def listed(spark: SparkSession, path: str) -> list[int]:
    return [int(x[:-5]) for x in shared.names(spark, f"{path}/_ledger") if x.endswith(".json")]


def put(spark: SparkSession, path: str, n: int, entry: dict) -> None:
    shared.put_text(spark, f"{path}/_ledger/{n:010d}.json", json.dumps(entry))


def entry(spark: SparkSession, path: str, n: int) -> dict:
    return json.loads(shared.get_text(spark, f"{path}/_ledger/{n:010d}.json"))


def offset(spark: SparkSession, path: str) -> dict | None:
    """The offset of the last listed batch (a batch without one has that of the batch before); None where nothing is listed."""
    done = listed(spark, path)
    return entry(spark, path, done[-1])["offset"] if done else None


def read(spark: SparkSession, path: str, kind: str = "") -> DataFrame | None:
    """The rows of all listed batches, with the number of the ``batch``; None where nothing is listed."""
    done = listed(spark, path)
    base = f"{path}/{kind}" if kind else path
    return spark.read.option("basePath", base).parquet(*[folder(path, n, kind) for n in done]) if done else None
