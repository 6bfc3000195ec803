"""Transactions of a redo log that is read as a stream.

State is kept for each transaction id: its changes so far, as a list that is appended to, never rewritten, and where it began.  Ids are
dealt to ``BUCKETS`` groups, which are the keys of the state, as a key costs far more than a row: a group asks the state once for what
is open in it, and again only for ids that were open before or stay so.  A commit emits them with its place, a rollback drops them, and the terminator of an unknown transaction emits nothing.  An open
transaction is never timed out.  State lives in the RocksDB store, spilled and checkpointed by Spark; at a commit it is
read and sent on row by row.

Besides, a narrow row tells that a transaction has begun, in the batch after which it is open for the first time, and that it has ended; of
these the low watermark of a batch is made (see ``plans.cdc``).  It begins with its first change that counts: one that is readable and not of a
temporary table.

Rows of one batch come in no order.  Those of a group are sorted as runs of ``PART`` rows: all but the last run wait in the state store in blocks
of ``BLOCK`` rows, and the runs are merged.  So a worker's memory holds PART rows and a block for each run (a million rows of one id: 100
blocks, 20,000 rows), the terminators that the group has in the batch, and a narrow row for each of its transactions that is open.
"""

from __future__ import annotations

import heapq
import json
import pickle
import time
from collections.abc import Callable, Iterator
from itertools import batched, chain, groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.schema import LOG, TEMPORARY, UNREADABLE

FIELDS = ["seq", "scn", "timestamp", "operation", "operation_code", "seg_owner", "table_name", "username", "sql_redo", "row_id", "csf", "xid", "status"]
CHANGE = StructType([LOG[x] for x in FIELDS])
OUT = StructType([*CHANGE.fields, StructField("commit_seq", LongType()), StructField("commit_scn", LongType())])
#: ``what``: change, opened or ended; the last two have xid, start_seq, min_scn and, at their end, commit_seq.
TRACED = StructType([*OUT.fields, StructField("what", StringType()), StructField("start_seq", LongType()), StructField("min_scn", LongType())])
SEQ, SCN, OPERATION, TEXT, CSF, XID, STATUS = (FIELDS.index(x) for x in ("seq", "scn", "operation", "sql_redo", "csf", "xid", "status"))
Record = Row(*TRACED.names)
_NUMBERS = [str(k) for k in range(len(FIELDS))]
#: The same with a change as one text, see ``packed``.
PACKED = StructType([StructField("row", StringType()), *(TRACED[x] for x in ("xid", "commit_seq", "commit_scn", "what", "start_seq", "min_scn"))])
PackedRecord = Row(*PACKED.names)
#: Where a transaction began, and, before that is known, the begin of the statement whose pieces come, the end of its text so far, and whether it is a temporary table's.
BEGIN = "start_seq long, min_scn long, piece_seq long, piece_scn long, tail string, temporary boolean"
NOTHING = (None, None, None, None, "", False)
#: Rows of an open transaction that are added to its state together, and of a batch that are sorted together.
PART = 10_000
#: Rows of a sorted run that are read together.
BLOCK = 100
#: Groups of transaction ids.
BUCKETS = 1024


def _begun(begin: tuple, rows: list[tuple]) -> tuple:
    """BEGIN after some more rows of a transaction."""
    start, low, piece, piece_scn, tail, temporary = begin
    for r in rows:
        if start is not None:
            break
        if piece is None:
            piece, piece_scn, tail, temporary = r[SEQ], r[SCN], "", False
        text = tail + (r[TEXT] or "")
        temporary = temporary or TEMPORARY in text
        tail = text[1 - len(TEMPORARY) :]
        if r[CSF] != 1:
            if not temporary and r[STATUS] != UNREADABLE:
                start, low = piece, piece_scn
            piece, piece_scn, tail, temporary = None, None, "", False
    return start, low, piece, piece_scn, tail, temporary


def packed() -> Column:
    """A row as JSON, its fields by their numbers."""
    return F.to_json(F.struct(*[(F.unix_micros(x) if x == "timestamp" else F.col(x)).alias(str(k)) for k, x in enumerate(FIELDS)]))


def _unpacked(r: Row) -> tuple:
    """The fields of a ``packed`` row, and itself."""
    found = json.loads(r[0])
    return (*[found.get(k) for k in _NUMBERS], r[0])


def unpacked(rows: DataFrame) -> DataFrame:
    """``PACKED`` rows as ``TRACED`` ones."""
    kind = ", ".join(f"`{k}` {'bigint' if x == 'timestamp' else LOG[x].dataType.simpleString()}" for k, x in enumerate(FIELDS))
    of = lambda k, x: F.timestamp_micros(F.col(f"row.`{k}`")) if x == "timestamp" else F.coalesce(F.col("xid"), F.col(f"row.`{k}`")) if x == "xid" else F.col(f"row.`{k}`")
    return rows.withColumn("row", F.from_json("row", kind)).select(*[of(k, x).alias(x) for k, x in enumerate(FIELDS)], *TRACED.names[len(FIELDS) :])


class Transactions(StatefulProcessor):
    """The transactions of one id."""

    order = staticmethod(itemgetter(SEQ))

    def __init__(self, control_from: int = 0, done_seq: int | None = None, part: int = PART, block: int = BLOCK):
        """Transactions that end before the SCN, or at or before the place, are settled and emit nothing."""
        self.control_from, self.done_seq, self.part, self.block = control_from, done_seq, part, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", CHANGE)
        self.begin = handle.getValueState("begin", BEGIN)
        self.runs = handle.getMapState("runs", "run int, block int", "rows binary")  # empty between batches

    def settled(self, end: tuple) -> bool:
        return end[SCN] < self.control_from if self.done_seq is None else end[SEQ] <= self.done_seq

    def run(self, k: int, blocks: int) -> Iterator[tuple]:
        for b in range(blocks):
            yield from pickle.loads(self.runs.getValue((k, b))[0])

    def in_order(self, rows: Iterator[Row]) -> tuple[list[tuple], Iterator[tuple], int]:
        """The terminators and the changes of a batch, both by their places, and how many runs wait in the state."""
        ends, part, sizes = [], [], []
        for r in rows:
            r = tuple(r)  # by place, as by name each is searched for
            (ends if r[OPERATION] in ("COMMIT", "ROLLBACK") else part).append(r)
            if len(part) == self.part:
                sizes.append(0)
                for rows_ in batched(sorted(part, key=self.order), self.block):
                    self.runs.updateValue((len(sizes) - 1, sizes[-1]), (pickle.dumps(rows_),))
                    sizes[-1] += 1
                part = []
        runs = [self.run(k, n) for k, n in enumerate(sizes)]
        return sorted(ends, key=self.order), heapq.merge(sorted(part, key=self.order), *runs, key=self.order), len(runs)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ends, changes, runs = self.in_order(rows)
        yield from self.settle(key[0], ends, changes, self.begin.get())
        if runs:
            self.runs.clear()

    def stored(self, xid: str | None) -> Iterator[tuple]:
        return self.open.get()

    def forget(self, xid: str | None) -> None:
        self.open.clear()
        self.begin.clear()

    def add(self, xid: str | None, rows: tuple) -> None:
        self.open.appendList(list(rows))

    def put(self, xid: str | None, begin: tuple) -> None:
        self.begin.update(begin)

    def change(self, row: tuple, place: tuple[int, int]) -> Row:
        return Record(*row, *place, "change", None, None)

    def told(self, xid: str | None, what: str, end: int | None, begin: tuple) -> Row:
        return Record(*[xid if k == XID else None for k in range(len(FIELDS))], end, None, what, *begin[:2])

    def settle(self, xid: str | None, ends: list[tuple], changes: Iterator[tuple], kept: tuple | None) -> Iterator[Row]:
        """What the terminators and the changes of an id give after what was ``kept``."""
        # each call of a state is a way to the JVM and back; changes are held just where a begin is
        held, begin = kept is not None, NOTHING if kept is None else tuple(kept)
        known = begin[0] is not None
        r = next(changes, None)
        for end in ends:
            place = (end[SEQ], end[SCN])
            wanted = end[OPERATION] == "COMMIT" and not self.settled(end)
            if wanted and held:
                for x in self.stored(xid):
                    yield self.change(x, place)
            while r is not None and r[SEQ] < end[SEQ]:
                begin = _begun(begin, [r])
                if wanted:
                    yield self.change(r, place)
                r = next(changes, None)
            if begin[0] is not None:
                yield self.told(xid, "ended", end[SEQ], begin)
            if held:
                self.forget(xid)
            held, begin, known = False, NOTHING, False
        if r is not None:
            for some in batched(chain([r], changes), self.part):
                begin = _begun(begin, some)
                self.add(xid, some)
            self.put(xid, begin)
            if begin[0] is not None and not known:
                yield self.told(xid, "opened", None, begin)

    def close(self) -> None:
        pass


class Group(Transactions):
    """The transactions of a group of ids, one id after the other.

    A row comes, waits and goes as one text, since each column of each row costs on its way to Python and back.
    """

    # a null id comes first
    order = staticmethod(lambda r: (r[XID] is not None, r[XID] or "", r[SEQ]))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.begins = handle.getMapState("begins", "xid string", f"{BEGIN}, blocks int")
        self.open = handle.getMapState("open", "xid string, block int", "rows binary")
        self.runs = handle.getMapState("runs", "run int, block int", "rows binary")  # empty between batches

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ends, changes, runs = self.in_order(map(_unpacked, rows))
        kept = {k[0]: tuple(v) for k, v in self.begins.iterator()}
        self.blocks = {xid: v[-1] for xid, v in kept.items()}
        of = {xid: list(some) for xid, some in groupby(ends, itemgetter(XID))}
        known = lambda xid: kept[xid][:-1] if xid in kept else None
        for xid, some in groupby(changes, itemgetter(XID)):
            yield from self.settle(xid, of.pop(xid, []), some, known(xid))
        for xid, some in of.items():
            yield from self.settle(xid, some, iter(()), known(xid))
        if runs:
            self.runs.clear()

    def change(self, row: tuple, place: tuple[int, int]) -> Row:
        return PackedRecord(row[-1], None, *place, "change", None, None)

    def told(self, xid: str | None, what: str, end: int | None, begin: tuple) -> Row:
        return PackedRecord(None, xid, end, None, what, *begin[:2])

    def stored(self, xid: str | None) -> Iterator[tuple]:
        for b in range(self.blocks[xid]):
            yield from pickle.loads(self.open.getValue((xid, b))[0])

    def forget(self, xid: str | None) -> None:
        for b in range(self.blocks.pop(xid)):
            self.open.removeKey((xid, b))
        self.begins.removeKey((xid,))

    def add(self, xid: str | None, rows: tuple) -> None:
        for some in batched(rows, 10 * self.block):
            b = self.blocks.get(xid, 0)
            self.open.updateValue((xid, b), (pickle.dumps(some),))
            self.blocks[xid] = b + 1

    def put(self, xid: str | None, begin: tuple) -> None:
        self.begins.updateValue((xid,), (*begin, self.blocks[xid]))


def traced(stream: DataFrame, control_from: int = 0, done_seq: int | None = None) -> DataFrame:
    """Changes of committed transactions of a streaming log, and where transactions begin and end (see ``TRACED``)."""
    rows = stream if "operation_code" in stream.columns else stream.withColumn("operation_code", _code(F))
    rows = rows.select(packed().alias("row"), F.pmod(F.hash("xid"), F.lit(BUCKETS)).alias("group"))
    return unpacked(rows.groupBy("group").transformWithState(statefulProcessor=Group(control_from, done_seq, PART, BLOCK), outputStructType=PACKED, outputMode="Append", timeMode="None"))


def committed(stream: DataFrame) -> DataFrame:
    """Changes of committed transactions of a streaming log, with commit_seq and commit_scn.  Rows without an operation_code get none."""
    return traced(stream).where("what = 'change'").select(*OUT.names)


def _code(F):
    from tidemark.operators.envelope import op_code

    return op_code(F.col("operation")).cast("int")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def log_files(spark: SparkSession, path: str, per_batch: int = 1) -> DataFrame:
    """A folder of redo log files as a stream, in the order of their times."""
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", per_batch).option("latestFirst", "false").parquet(path)


def started(out, poll_ms: int | None = None):
    """A stream's writer, started: every ``poll_ms``, or until what is there is read."""
    return (out.trigger(availableNow=True) if poll_ms is None else out.trigger(processingTime=f"{poll_ms} milliseconds")).start()


def write(stream: DataFrame, path: str, checkpoint: str, poll_ms: int | None = None):
    """Write to files, exactly once; without ``poll_ms`` what is there is read and the query ends."""
    return started(stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append"), poll_ms)


def supervise(start: Callable[[], object], transient: tuple[str, ...], attempts: int, backoff_ms: int) -> None:
    """Run a stream to its end; after a failure whose text has one of ``transient`` (a lost connection) start it again.

    It goes on from its checkpoint.  Other failures, and more than ``attempts`` in a row without a new batch between them,
    go to the caller.
    """
    failed, done = 0, -1
    while True:
        query = start()
        try:
            query.awaitTermination()
            return
        except Exception as e:
            last = (query.lastProgress or {}).get("batchId", done)
            failed = 1 if last > done else failed + 1
            done = max(done, last)
            if failed > attempts or not any(x in str(e) for x in transient):
                raise
            time.sleep(backoff_ms / 1000)
        finally:
            query.stop()


def throughput(query) -> list[tuple[int, float]]:
    """(batch, rows read a second) of a stream's recent batches, from Spark's own progress."""
    return [(p["batchId"], p["processedRowsPerSecond"]) for p in query.recentProgress if p["numInputRows"]]
