"""The whole way from a redo log to change records, as a batch and as a stream.

``write`` and ``stream`` deliver to a path that keeps a list of its batches (``plans.ledger``): records in the order of commits, the
changes that could not be delivered with the reason, and the offset to go on from.  ``begin`` tells where a job goes on: at the path's
offset, after its snapshot, or at start.scn.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import shared
from tidemark.config import Config
from tidemark.operators import asof, envelope, parse, reassembly, scan, transactions
from tidemark.plans import ledger
from tidemark.sources import snapshot
from tidemark.sources.catalog import Catalog, tables_of
from tidemark.streaming import transactions as streaming

CONNECTOR = "tidemark"
#: Rows of a table that a snapshot delivers together.
RANGE_ROWS = 20_000_000


Put = Callable[[DataFrame, str], DataFrame]


def _scanned(rows: DataFrame) -> DataFrame:
    """Rows of a log to be written: with the mark of temporary tables, so that readers of narrow columns needn't look into statements."""
    return rows.withColumn("_temporary", ~scan.not_temporary())


def _statements(scanned: DataFrame, put: Put) -> DataFrame:
    """The whole statements of what was ``_scanned`` and written, without temporary tables; where none is in pieces, its rows as they are."""
    if scanned.where("csf = 1").isEmpty():
        return scanned.where("NOT _temporary").drop("_temporary")
    return put(scan.drop_temporary(reassembly.reassemble(scanned.drop("_temporary"))), "kept")


def _left(log: DataFrame, config: Config, scn: int, commit_scn: int, complete: bool, put: Put = shared.written) -> DataFrame:
    """The log from an offset's first change on, reassembled and written: terminators, too, as each change has to meet its own."""
    change_from, control_from = scan.bounds(scn, commit_scn, complete)
    return _statements(put(_scanned(scan.scan(log, config.selectors, change_from, min(change_from, control_from))), "scanned"), put)


def _unsettled(kept: DataFrame, scn: int, commit_scn: int, complete: bool, done_seq: int | None) -> DataFrame:
    change_from, control_from = scan.bounds(scn, commit_scn, complete)
    return transactions.unfinished(kept, control_from, done_seq) if control_from > change_from or done_seq is not None else kept


def _ready(kept: DataFrame, config: Config, scn: int, commit_scn: int, complete: bool, done_seq: int | None, put: Put = shared.written) -> DataFrame:
    """Committed, readable changes after an offset, with offsets, of what is ``_left``; commits, numbers and watermarks read its narrow columns."""
    rows = scan.drop_unreadable(_unsettled(kept.select("seq", "xid", "scn", "operation", "status"), scn, commit_scn, complete, done_seq))
    return transactions.record_offsets(rows, config["batch.size"], scan.drop_unreadable(kept), put)


def changes(log: DataFrame, config: Config, scn: int = 0, commit_scn: int = 0, complete: bool = False, done_seq: int | None = None) -> DataFrame:
    """Committed, readable changes of the selected tables after an offset, with offsets; statements are not parsed yet.

    What is left of the log is written once: commits, numbers and watermarks then read its narrow columns, not the log again.
    Transactions that ended before the offset (with ``done_seq``: up to that place of the log) are taken out once their changes have met their ends.
    """
    return _ready(_left(log, config, scn, commit_scn, complete), config, scn, commit_scn, complete, done_seq)


def parsed(log: DataFrame, config: Config, **offset) -> DataFrame:
    """Committed changes after an offset with their images; they meet their commits first, so what was rolled back is never parsed.

    Changes that can't be parsed are not among them; ``outcomes`` has them, too.
    """
    return parse.drop_unparsable(changes(log, config, **offset))


def kinds(config: Config, catalog: Catalog) -> Iterator[tuple[tuple[str, str, int | None], Column, StructType, StructType | None]]:
    """(owner, table, version of the table), which changes it has, and its value and key schemas, for all selected tables.

    With db.dictionary REDO_LOG a change is read by the schema that its table had at its SCN, if the catalog has versions;
    with ONLINE by the latest (None).
    """
    for owner, table in dict.fromkeys(tables_of(catalog.columns, config.selectors)):
        starts = catalog.versions(owner, table) if config["db.dictionary"] == "REDO_LOG" else [None]
        for k, start in enumerate(starts):
            own = (F.col("seg_owner") == owner) & (F.col("table_name") == table)
            # the first version holds for what is older, too
            own = own & (F.col("scn") >= start) if k else own
            own = own & (F.col("scn") < starts[k + 1]) if k + 1 < len(starts) else own
            yield (owner, table, start), own, *catalog.schemas(owner, table, start)


def records(log: DataFrame, config: Config, catalog: Catalog, **offset) -> dict[tuple[str, str, int | None], DataFrame]:
    """Typed change records (topic, key, value, part, offset) by owner, table and version, after an offset.

    Each table has row types of its own and so reads the log itself; ``texts`` makes the records of all tables in one pass.
    """
    rows, out = parsed(log, config, **offset), {}
    for kind, own, value, key in kinds(config, catalog):
        made = envelope.envelopes(rows.where(own), value, key, config["db.name"], CONNECTOR, config["db.timezone"])
        good, _ = envelope.split_invalid(made, value)
        out[kind] = envelope.with_tombstones(good, config["tombstones.on.delete"])
    return out


#: Why a committed change was not delivered.
UNREADABLE, UNPARSABLE, NO_TABLE, NO_COLUMN, INVALID = "unreadable", "unparsable", "unknown table", "unknown column", "required column is null"


def texts_of(rows: DataFrame, config: Config, catalog: Catalog, outcomes: bool = False) -> DataFrame:
    """The records of parsed changes of all tables: topic, key and value as JSON (a null value for a tombstone), part, and the place.

    One pass: each change is typed by the columns that its table had then (see ``operators.asof``), and generates its records.  A column that
    the table lacks is an error; with ``outcomes`` (of changes with ``parsed``) a change without records is a row, too, with a
    ``reason`` and itself as ``change``.
    """
    given = rows.columns
    rows = rows.withColumn("image", parse.after_image(envelope.op_code(F.col("operation")), F.col("before"), F.col("after"))).withColumn("op", envelope.op_letter(F.col("operation")))
    place = [c for c in ("offset", "commit_seq", "seq") if c in given]
    rows = asof.made(rows, config, catalog, CONNECTOR, not outcomes)
    if not outcomes:
        return rows.select(F.inline(F.col("_made.records")), *place)
    out = rows.select(F.inline_outer(F.when(F.col("parsed"), F.col("_made.records"))), *place, F.struct(*given).alias("_change"), "parsed", F.col("_made").isNotNull().alias("_known"), F.col("_made.drift").alias("_drift"))
    reason = F.when(~F.col("parsed"), UNPARSABLE).when(~F.col("_known"), NO_TABLE).when(F.col("_drift"), NO_COLUMN).when(F.col("topic").isNull(), INVALID)
    return out.withColumn("reason", reason).withColumn("change", F.when(F.col("reason").isNotNull(), F.col("_change"))).drop("_change", "parsed", "_known", "_drift")


def texts(log: DataFrame, config: Config, catalog: Catalog, **offset) -> DataFrame:
    """The records of all selected tables after an offset, with key and value as JSON (see ``texts_of``)."""
    return texts_of(parsed(log, config, **offset), config, catalog)


def _retyped(out: DataFrame, config: Config, catalog: Catalog) -> DataFrame:
    """Outcomes in which the changes with unknown columns are typed again, after one refresh of the catalog; those alone, so what
    fits is not typed twice.  A column that is still unknown is an error."""
    late = out.where(F.col("reason") == NO_COLUMN)
    if late.isEmpty():
        return out
    catalog.refresh()
    again = texts_of(late.select("change.*").where("parsed"), config, catalog).withColumn("reason", F.lit(None).cast("string")).withColumn("change", F.lit(None).cast(out.schema["change"].dataType))
    return out.where(F.coalesce(F.col("reason"), F.lit("")) != NO_COLUMN).unionByName(again)


def _unread(rows: DataFrame, like: DataFrame) -> DataFrame:
    """Committed changes that the log could not read, as outcomes."""
    names = like.schema["change"].dataType
    change = F.struct(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in names])
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema if f.name not in ("commit_seq", "seq", "reason", "change")]
    return rows.select(*empty, "commit_seq", "seq", F.lit(UNREADABLE).alias("reason"), change.alias("change"))


@contextmanager
def _delivered(ready: DataFrame, unread: DataFrame, config: Config, catalog: Catalog) -> Iterator[DataFrame]:
    """Outcomes of committed changes with offsets, and of unreadable ones; held, as they are read several times."""
    first = texts_of(parse.parse(ready), config, catalog, True)
    with shared.held(first.unionByName(_unread(unread, first)), "outcomes") as held:
        retyped = _retyped(held, config, catalog)
        if retyped is held:
            yield held
        else:
            with shared.held(retyped, "retyped") as again:
                yield again


def outcomes(log: DataFrame, config: Config, catalog: Catalog, scn: int = 0, commit_scn: int = 0, complete: bool = False, done_seq: int | None = None) -> DataFrame:
    """The records of all selected tables after an offset, and the changes that give none: unreadable, not parsed, of a table or with a
    column that the catalog lacks, or without a required column; these have a ``reason`` and the ``change``, and no topic.

    Each committed change that is not of a temporary table is there: as a record of part 0, or with a reason.
    """
    kept = _left(log, config, scn, commit_scn, complete)
    first = texts_of(parse.parse(_ready(kept, config, scn, commit_scn, complete, done_seq)), config, catalog, True)
    return first.unionByName(_unread(_unreadable(kept, scn, commit_scn, complete, done_seq), first))


def _unreadable(kept: DataFrame, scn: int, commit_scn: int, complete: bool, done_seq: int | None) -> DataFrame:
    rows = kept.where(transactions.is_terminator() | (F.col("status") == scan.UNREADABLE))
    return transactions.committed_changes(_unsettled(rows, scn, commit_scn, complete, done_seq)).where(F.col("status") == scan.UNREADABLE)


#: The order of delivery.
ORDER = ("commit_seq", "seq", "part")


def _put(out: DataFrame, config: Config, path: str, n: int) -> dict:
    """Deliver outcomes as a path's batch n: records by ranges of ORDER, so that files in the order of their names, read from
    begin to end, have them in the order of commits; then what was rejected; then the batch's entry in the list."""
    spark = out.sparkSession
    good = out.where("reason IS NULL").drop("reason", "change")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    good.repartitionByRange(files, *ORDER).sortWithinPartitions(*ORDER).write.mode("overwrite").parquet(ledger.folder(path, n))
    out.where("reason IS NOT NULL").select("reason", "change.*").write.mode("overwrite").parquet(ledger.folder(path, n, "_rejected"))
    counts = {r["reason"] or ("tombstone" if r["part"] else "record"): r["count"] for r in out.groupBy("reason", F.when(F.col("reason").isNull(), F.col("part")).alias("part")).count().collect()}
    last = out.where("offset IS NOT NULL").agg(F.max_by(F.struct("offset.*", F.col("commit_seq").alias("commitSeq")), F.struct("commit_seq", "seq")).alias("at")).first()["at"]
    before = [x for x in ledger.listed(spark, path) if x < n]
    at = last.asDict() if last else ledger.entry(spark, path, before[-1])["offset"] if before else None
    entry = {"source": config.source_partition, "offset": at, "counts": counts}
    ledger.put(spark, path, n, entry)
    return entry


def write(log: DataFrame, config: Config, catalog: Catalog, path: str, scn: int = 0, commit_scn: int = 0, complete: bool = False, done_seq: int | None = None) -> dict:
    """Deliver the records of all tables after an offset as the next batch of a path; its entry in the list, with counts.

    A batch that fails leaves the list as it was, and the next one replaces its files.
    """
    done = ledger.listed(log.sparkSession, path)
    with ExitStack() as held:
        at = (scn, commit_scn, complete, done_seq)
        put = lambda df, name: held.enter_context(shared.held(df, name))
        kept = _left(log, config, scn, commit_scn, complete, put)
        out = held.enter_context(_delivered(_ready(kept, config, *at, put), _unreadable(kept, *at), config, catalog))
        return _put(out, config, path, done[-1] + 1 if done else 0)


def stored_offset(spark: SparkSession, path: str) -> dict | None:
    """The offset to go on from after what is listed under ``path``; None without any."""
    return ledger.offset(spark, path)


def bounds_of(at: dict | None) -> dict:
    """An offset as the arguments of ``changes``, ``write`` and ``texts``; where the place of its commit is known, that tells what is done."""
    if at is None:
        return {}
    known = at.get("commitSeq") if at["isTransactionComplete"] else None
    return {"scn": at["scn"], "commit_scn": at["commitScn"], "complete": at["isTransactionComplete"], "done_seq": known}


def begin(spark: SparkSession, config: Config, path: str) -> dict:
    """Where a job over a path goes on, as arguments of ``write``: at its offset, at the SCN of its snapshot, or at start.scn."""
    done = ledger.listed(spark, path)
    if done and (more := ledger.entry(spark, path, done[-1]).get("open")):
        raise ValueError(f"the snapshot in {path} is not whole (more of its {'last ' * (more == 'table')}{more} is to come); go on with write_snapshot")
    kind, at = snapshot.plan(ledger.offset(spark, path), config["start.scn"])
    return bounds_of(snapshot.handover(at) if kind == "snapshot" and at else at)


def go_on(log: DataFrame, config: Config, catalog: Catalog, path: str) -> dict:
    """``write`` what a path lacks of a log."""
    return write(log, config, catalog, path, **begin(log.sparkSession, config, path))


def write_snapshot(tables: Callable[[str, str, int], DataFrame], scn: int, config: Config, catalog: Catalog, path: str, range_rows: int = RANGE_ROWS, most: int | None = None) -> int:
    """Deliver a snapshot of all selected tables as batches of a path, one for about ``range_rows`` rows of a table by row id, before
    the log; the SCN that it is of.

    ``tables`` gives a table's rows as of an SCN, with row_id and row_scn.  A snapshot that was broken off, or ended after ``most`` batches, goes on at
    its own SCN after the last row id that is listed; ``begin`` refuses a path whose snapshot has not come to its end.  Tables that come twice in
    the list of selectors are read once.  Within a batch rows come in no order.
    """
    spark = catalog.columns.sparkSession
    done = {n: ledger.entry(spark, path, n) for n in ledger.listed(spark, path)}
    n, at_table = max(done, default=-1), {}
    for e in done.values():
        if (e["offset"] or {}).get("type") == "select":
            scn, at_table[e["offset"]["owner"], e["offset"]["table"]] = e["offset"]["scn"], e
    wanted = list(dict.fromkeys(tables_of(catalog.columns, config.selectors)))
    left = [t for t in wanted if t not in at_table or at_table[t].get("open") == "table"]
    if left and done and (done[n]["offset"] or {}).get("type") == "cdc":
        raise ValueError(f"{path} has the log already; these tables need a snapshot of their own path: {left}")
    for k, (owner, table) in enumerate(left):
        value, key = catalog.schemas(owner, table)
        rows = snapshot.extract(tables(owner, table, scn), value, config["db.timezone"])
        last = at_table[owner, table]["offset"]["rowId"] if (owner, table) in at_table else None
        for begin_, upto in snapshot.ranges(snapshot.after(rows, last), range_rows):
            if most is not None and n - max(done, default=-1) >= most:
                return scn
            n += 1
            part = snapshot.read(snapshot.between(rows, last if begin_ is None else begin_, upto), owner, table, scn, CONNECTOR)
            keys = F.to_json(F.struct(*[F.col("after")[f.name].alias(f.name) for f in key])) if key else F.lit(None).cast("string")
            made = F.to_json(F.struct("op", "before", "after", "source", F.current_timestamp().alias("ts_ms")))
            out = part.select(envelope.topic_name(config["db.name"], F.lit(owner), F.lit(table)).alias("topic"), keys.alias("key"), made.alias("value"), F.lit(0).alias("part"), F.col("offset.rowId").alias("row_id"))
            out.write.mode("overwrite").parquet(ledger.folder(path, n))
            count, end = spark.read.parquet(ledger.folder(path, n)).agg(F.count("*"), F.max(F.col("row_id").cast(rows.schema["row_id"].dataType)).cast("string")).first()
            offset = {"type": "select", "scn": scn, "owner": owner, "table": table, "rowId": end}
            more = "table" if upto is not None else "tables" if k + 1 < len(left) else None
            ledger.put(spark, path, n, {"source": config.source_partition, "offset": offset, "counts": {"record": count}, "open": more})
    if not left and done and done[n].get("open"):  # the tables that it had before it aren't selected any more
        ledger.put(spark, path, n, done[n] | {"open": None})
    return scn


def _watermarks(rows: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(low watermark of a batch's commits, transactions that are open after it), of a stream's traced rows and what was open before."""
    span = ["xid", "start_seq", "min_scn"]
    ended = rows.where("what = 'ended'").select(*span, F.col("commit_seq").alias("end_seq"))
    opened = rows.where("what = 'opened'").select(*span)
    still = opened if before is None else opened.unionByName(before.select(*span))
    still = still.join(ended.select("xid", "start_seq"), ["xid", "start_seq"], "left_anti").select(*span)
    commits = rows.where("what = 'change'").select("xid", "commit_seq").distinct()
    stop = (commits.agg(F.max("commit_seq").alias("stop")).first()["stop"] or 0) + 1
    spans = ended.unionByName(still.withColumn("end_seq", F.lit(None).cast("long")))
    return transactions.lowest(commits, spans, stop), still


def stream(log: DataFrame, config: Config, catalog: Catalog, path: str, checkpoint: str, poll_ms: int | None = None, at: dict | None = None):
    """The same from a streaming log: each batch's committed changes are a batch of the path, with the offsets that the batch job gives.

    It begins at the offset ``at``, or where ``begin`` says; what it began with is kept with its checkpoint, which then holds open transactions
    and the place in the log.  A batch that is run again after a failure replaces its own files, so every record is there once.  What comes
    out of a batch are whole transactions, so statements are put together, numbered and parsed there.  Which transactions are open after a batch is a narrow
    table beside it, of which the next batch makes its low watermark; the one before the last is deleted.  ``poll_ms`` is poll.interval.ms if it is 0.
    """
    spark = log.sparkSession
    streaming.use_rocksdb(spark)
    known = f"{checkpoint}/tidemark-begin.json"
    if not shared.exists(spark, known):
        done = ledger.listed(spark, path)
        start = bounds_of(at) if at else begin(spark, config, path)
        shared.put_text(spark, known, json.dumps({"from": start, "first": done[-1] + 1 if done else 0}))
    stored = json.loads(shared.get_text(spark, known))
    start, first = {"scn": 0, "commit_scn": 0, "complete": False, "done_seq": None} | stored["from"], stored["first"]
    change_from, control_from = scan.bounds(start["scn"], start["commit_scn"], start["complete"])

    def batch(rows: DataFrame, k: int) -> None:
        n = first + k
        with ExitStack() as held:
            put = lambda df, name: held.enter_context(shared.held(df, name))
            # a batch that is read twice would go through the state twice
            rows = put(_scanned(rows), "batch")
            before = spark.read.parquet(ledger.folder(path, n - 1, "_open")) if k and shared.exists(spark, ledger.folder(path, n - 1, "_open")) else None
            low, open_ = _watermarks(rows, before)
            open_.write.mode("overwrite").parquet(ledger.folder(path, n, "_open"))
            whole = _statements(rows.where("what = 'change'").select(*streaming.OUT.names, "_temporary"), put)
            ready = transactions.with_offsets(scan.drop_unreadable(whole), low, config["batch.size"])
            _put(held.enter_context(_delivered(ready, whole.where(F.col("status") == scan.UNREADABLE), config, catalog)), config, path, n)
            shared.delete(spark, ledger.folder(path, n - 2, "_open"))

    out = streaming.traced(scan.scan(log, config.selectors, change_from, min(change_from, control_from)), control_from, start["done_seq"]).writeStream.foreachBatch(batch)
    return streaming.started(out.option("checkpointLocation", checkpoint).outputMode("append"), config["poll.interval.ms"] if poll_ms == 0 else poll_ms)


def hand_over(snapshot_scn: int | None, log: DataFrame, config: Config, catalog: Catalog) -> DataFrame:
    """The records (see ``texts``) of the log after a snapshot as of an SCN (None: no snapshot; start.scn counts)."""
    at = snapshot.handover(None if snapshot_scn is None else {"scn": snapshot_scn}, config["start.scn"])
    return texts(log, config, catalog, scn=at["scn"], commit_scn=at["commitScn"], complete=at["isTransactionComplete"])
