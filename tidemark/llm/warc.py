"""WARC archives: one gzip member for each record, read back in splits.

Writing: of records with equal payloads of at least ``revisit_bytes`` bytes the one with the smallest page id is a
response with the payload; the others are revisits that refer to it.  Smaller payloads are always responses.  The first
of each payload comes from a minimum that combines before the shuffle; the payloads with the most records, at most
``HOT``, are looked up by broadcast, so that no task gets more than 1/HOT of the records for one payload.  Each task
writes files of its own, whose names no other attempt uses, and the manifest (a table) lists those of the attempts that
were committed; readers see only these.

Reading: files are cut into ranges of bytes.  A task scans its range for the gzip magic, takes a candidate for a member
if it inflates to a WARC header, and owns the records that start inside the range.  From one record on, the next starts
where it ends; after broken bytes the scan goes on.  Nothing is left out in silence: a member that breaks off, a record
without a length or shorter than it says, and a member found by scanning that no other follows (it may be part of the
payload of one that was stored without compression) come with a ``problem``.

Defined results: a null payload is empty; a null page id is never referred to, and its record is a response unless an
equal payload has an id; records with the smallest id of a payload (repeated rows) are all responses, of one record id; a null
URL has no header; an empty table gives an empty manifest; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, small_batches, stored, table

#: Payloads looked up by broadcast at most.
HOT = 1024
#: A file ends after the record with which it reaches this size; a split of a file has SPLIT_BYTES.
FILE_BYTES, SPLIT_BYTES = 1 << 30, 16 << 20
#: Bytes read at a time, and tasks that read an archive at most (each takes several splits then).
READ_BYTES, TASKS = 1 << 20, 100_000

_MAGIC = b"\x1f\x8b\x08"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(rb"[\x00-\x1f\x7f]|^ | $")


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def record(page: int | None, url: bytes | None, payload: bytes, digest: bytes, first: int | None, date: str) -> bytes:
    """One WARC record, not compressed.  ``first``: the page of the response that a revisit refers to."""
    revisit = first is not None
    urn = lambda n: b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{n}:{digest.hex()}")).encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + urn(page), b"WARC-Date: " + date.encode()]
    if url is not None:
        head.append(b"Page-URL-Base64: " + base64.b64encode(url) if _UNSAFE.search(url) or not url else b"WARC-Target-URI: " + url)
    head.append(b"WARC-Payload-Digest: sha1:" + base64.b32encode(digest))
    if page is not None:
        head.append(b"Page-ID: %d" % page)
    if revisit:
        head += [b"WARC-Profile: " + _PROFILE, b"WARC-Refers-To: " + urn(first), b"Refers-To-Page-ID: %d" % first]
    head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def first_pages(pages: DataFrame, revisit_bytes: int) -> DataFrame:
    """``pages`` (page, url, payload as string) with its SHA-1 as ``digest`` and, for revisits, the page referred to as ``first``."""
    rows = pages.withColumn("digest", F.unhex(F.sha1(F.col("payload").cast("binary"))))
    large = rows.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    large = stored(large.where("n > 1 AND first IS NOT NULL"), "payloads")
    hot = large.orderBy(F.desc("n"), "digest").limit(HOT)
    rows = rows.join(F.broadcast(hot.select(F.col("digest").alias("hot"), F.col("first").alias("hot_first"))), F.col("digest") == F.col("hot"), "left")
    # a hot row's key is like no digest, so it goes anywhere; n > 1 rows of 36 bytes are looked up by shuffling unless they are few
    key = F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.unhex(F.sha2(F.concat(F.col("digest"), F.coalesce(F.col("page"), F.lit(0)).cast("string").cast("binary")), 256)))
    rest = large.join(F.broadcast(hot.select("digest")), "digest", "left_anti").select(F.col("digest").alias("cold"), F.col("first").alias("cold_first"))
    rows = rows.withColumn("key", key).join(rest, F.col("key") == F.col("cold"), "left")
    first = F.coalesce("hot_first", "cold_first")
    return rows.select("page", "url", "payload", "digest", F.when(~F.col("page").eqNullSafe(first), first).alias("first"))


def write(df: DataFrame, out: str, id: str = "page_id", url: str = "url", payload: str = "html", revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write an archive under ``out`` and return its manifest: path, bytes, records."""
    spark = df.sparkSession
    small_batches(spark)
    pages = df.select(F.col(id).cast("long").alias("page"), F.col(url).alias("url"), F.coalesce(payload, F.lit("")).alias("payload"))
    rows = first_pages(pages, revisit_bytes)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = filesystem(out)
        system.create_dir(folder, recursive=True)
        sink, name, size, n = None, "", 0, 0
        for b in batches:
            columns = [b.column(0), b.column(1).cast(pa.binary()), b.column(2).cast(pa.binary()), b.column(3), b.column(4)]
            for row in zip(*(x.to_pylist() for x in columns)):
                if sink is None:
                    name, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = system.open_output_stream(name, compression=None)
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = press.compress(record(*row, date)) + press.flush()
                sink.write(member)
                size, n = size + len(member), n + 1
                if size >= FILE_BYTES:
                    sink.close()
                    yield _listed(out, name, size, n)
                    sink = None
        if sink is not None:
            sink.close()
            yield _listed(out, name, size, n)

    return stored(rows.mapInArrow(over, "path string, bytes long, records long"), "manifest")


def _listed(out: str, name: str, size: int, n: int) -> pa.RecordBatch:
    path = f"{out}/{name.rpartition('/')[2]}"
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])


class Source:
    """A file read forwards in pieces, from any place."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        got = self.file.read(READ_BYTES)
        self.held += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.at, self.held = self.at + n, self.held[n:]

    def ended(self) -> bool:
        return not self.held and not self.more()


def is_member(source: Source) -> bool:
    """Whether what comes next inflates to a WARC header, however long the gzip header before it is.  Nothing is dropped."""
    while len(source.held) < len(_MAGIC) and source.more():
        pass
    if not source.held.startswith(_MAGIC):
        return False
    inflate, got, fed = zlib.decompressobj(31), b"", 0
    try:
        while len(got) < 5 and not inflate.eof:
            if fed == len(source.held) and not source.more():
                return False
            part = inflate.unconsumed_tail or source.held[fed : fed + 512]
            fed += 0 if inflate.unconsumed_tail else len(part)
            got += inflate.decompress(part, 5 - len(got))
    except zlib.error:
        return False
    return got == b"WARC/"


def members(file, start: int, end: int) -> Iterator[tuple[int, bytes, str | None]]:
    """(place, content, problem) of the members that start in [start, end) of a seekable file."""
    source, chained = Source(file, start), start == 0
    while source.at < end:
        if not is_member(source):
            chained = False
            at = source.held.find(_MAGIC, 1)
            if at < 0:
                at = max(1, len(source.held) - 2)
                if not source.held or (len(source.held) <= 2 and not source.more()):
                    return
            source.drop(at)
            continue
        inflate, parts, begin, used, broken = zlib.decompressobj(31), [], source.at, 0, None
        try:
            while not inflate.eof:
                if source.ended():
                    raise zlib.error
                parts.append(inflate.decompress(source.held))
                used += len(source.held)
                source.held = b""
        except zlib.error:
            yield begin, b"".join(parts), "broken member"
            source, chained = Source(file, begin + 1), False
            continue
        source.held = inflate.unused_data
        source.at = begin + used - len(source.held)
        doubtful = not chained and not source.ended() and not is_member(source)
        yield begin, b"".join(parts), "found inside other bytes" if doubtful else None
        chained = not doubtful


def parse(content: bytes) -> dict:
    """The fields of a record; ``problem`` says if it has no length or isn't whole."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
    number = lambda x: int(fields[x]) if fields.get(x, b"").isdigit() else None
    size = number(b"content-length")
    problem = "no length" if size is None else "cut off" if len(rest) < size else None
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    url = fields.get(b"warc-target-uri")
    if b"page-url-base64" in fields:
        url = base64.b64decode(fields[b"page-url-base64"])
    said = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:") or None
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode() if kind == "response" else said
    return {
        "record_type": kind, "url": None if url is None else url.decode("utf-8", "replace"), "page_id": number(b"page-id"), "refers_to": number(b"refers-to-page-id"),
        "payload_bytes": len(payload) if kind == "response" else int(length[1]) if length else None, "payload_digest": found, "intact": found == said and not problem,
        "payload": payload if kind == "response" else None, "problem": problem,
    }


FIELDS = "path string, place long, record_type string, url string, page_id long, refers_to long, payload_bytes long, payload_digest string, intact boolean, payload binary, problem string"


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records (FIELDS) of the files (path, bytes); ``problem`` is null for those that are whole."""
    splits = files.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    splits = splits.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("stop"))
    n = files.agg(F.sum(F.ceil(F.greatest(F.col("bytes"), F.lit(1)) / split_bytes))).first()[0]
    names = [x.split()[0] for x in FIELDS.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.string()]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[x] for r in rows], t) for x, t in zip(names, types)], names=names)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for path, start, stop in zip(*(x.to_pylist() for x in b.columns)):
                system, at = filesystem(path)
                with system.open_input_file(at) as file:
                    for place, content, problem in members(file, start, stop):
                        r = parse(content)
                        rows.append({"path": path, "place": place} | r | {"problem": problem or r["problem"]})
                        size += len(content)
                        if size >= 8 * READ_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
        yield batch(rows)

    return splits.repartition(max(1, min(int(n or 1), TASKS))).mapInArrow(over, FIELDS)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """The files (path, bytes) of an archive that has no manifest; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(path).select("path", F.col("length").alias("bytes"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write(table(spark, sf_dir, "pages"), scratch(spark, "archive"))
    return read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + substr(bits, (5 * i + 1)::INT, 5)::BIT::INT, 1) for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""
