"""Substring deduplication over super-k-mers.

A window is ``width`` consecutive words of one document.  A word is removed if a window over it also starts in a
document with a smaller id.  The minimiser of a window is the smallest hash among its runs of ``GRAM`` words;
consecutive windows with one minimiser travel as one packed string of words to the bucket of that minimiser, where all
equal windows meet and sorting finds the smallest id of each.

A first pass over the input marks, in a bit map of at most ``MOST_SLOTS`` bits, the slots of minimisers that two or more
documents have; only windows in marked slots can have an equal elsewhere, and only they travel (when the map is full all
do: it saves work and never decides).  Before they travel, the windows of a part of the input (``TOGETHER`` bytes) are
sorted there: all but those of the smallest id are settled at once, so that a passage of any number of documents reaches
its bucket once for each part, and a part's strings of one bucket go as one compressed row.  The places found come back as
spans, are gathered for each document, and cut out of it.  Windows meet by a 64-bit key and are then compared word by word.

The same pass counts the parts that have a slot.  Windows of a slot that very many have (see ``HOT``) go one by one, by a hash
of all their words, so that no minimiser makes its bucket large.  A bucket is settled whenever
``TOGETHER`` bytes of it are held, and goes on with the windows of the smallest ids: it holds different windows, not copies.

Defined results: a null text has no words; documents of fewer than ``width`` words keep all; a null id counts as
largest; rows of equal id never remove each other's words, and repeated rows get equal results; an empty table gives no
rows; other columns pass through ``dedup`` whatever their names; ids that are no whole numbers raise TypeError.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegralType, LongType, StringType, StructField, StructType

from tidemark.llm.common import small_batches, table

#: Words of a minimiser.
GRAM = 3
#: Bytes of text whose windows are sorted together before they travel, and of packed strings sorted in a bucket's task.
TOGETHER = 5_000_000
#: Slots of the bit map for each byte of text, slots of a segment of it, and its slots at most (32 MB).
SLOTS_PER_BYTE, SEGMENT, MOST_SLOTS = 0.25, 1 << 16, 1 << 28
#: Bytes of text for each bucket.
BUCKET_BYTES = 4_000_000
#: A slot is hot if its count (one for each part that has it, two if two documents there do) is over HOT and over EVEN times
#: the mean of the slots around: so at most 1 / EVEN of the slots are, and their numbers take 64 MB at most.
HOT, EVEN = 4096, 16
#: Of zstd, for packed strings.
LEVEL = 5
#: What a null id counts as.
LAST = 2**63 - 1

_MIX = np.random.default_rng(9).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


class Limits(NamedTuple):
    together: int
    segment: int
    hot: int
    even: float


class Words:
    """Words of many texts in one row: ``ids`` equal iff the words are, ``h`` a hash that depends on the word alone."""

    def __init__(self, lists: list[list[bytes]]):
        number: dict[bytes, int] = defaultdict(count().__next__)
        self.size = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ids = np.fromiter(map(number.__getitem__, chain.from_iterable(lists)), np.int64, int(self.size.sum()))
        self.h = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))[self.ids]
        self.text = np.repeat(np.arange(len(lists)), self.size)
        self.first = np.cumsum(self.size) - self.size

    def windows(self, width: int) -> np.ndarray:
        n = max(0, len(self.ids) - width + 1)
        return np.flatnonzero(self.text[:n] == self.text[width - 1 :][:n])

    def keys(self, at: np.ndarray, width: int) -> np.ndarray:
        """For each window a hash of its words in their order."""
        key = np.zeros(len(at), np.uint64)
        for k in range(width):
            key += self.h[at + k] * _MIX[k % len(_MIX)] * np.uint64(2 * (k // len(_MIX)) + 1)
        return key

    def alike(self, at: np.ndarray, width: int) -> np.ndarray:
        """For each window the number of its class of equal windows."""
        key = self.keys(at, width)
        order = np.argsort(key)
        key, rank = key[order], at[order]
        same = np.flatnonzero(key[1:] == key[:-1])
        if not all((self.ids[rank[same] + k] == self.ids[rank[same + 1] + k]).all() for k in range(width)):
            rows = np.stack([self.ids[at + k] for k in range(width)])  # different windows have one key
            order = np.lexsort(rows)
            new = (rows[:, order][:, 1:] != rows[:, order][:, :-1]).any(axis=0)
        else:
            new = key[1:] != key[:-1]
        out = np.empty(len(at), np.int64)
        out[order] = np.cumsum(np.r_[False, new]) if len(at) else 0
        return out

    def minimisers(self, at: np.ndarray, width: int) -> np.ndarray:
        """For each window its smallest gram hash."""
        gram = min(GRAM, width)
        g = np.zeros(len(self.h), np.uint64)
        for k in range(gram):
            g[: len(g) - k] += self.h[k:] * _MIX[-1 - k]
        g ^= g >> np.uint64(31)
        g *= np.uint64(0x9E3779B97F4A7C15)
        left, step = width - gram + 1, 1
        low = g
        while 2 * step <= left:
            low = np.minimum(low, np.r_[low[step:], low[len(low) - step :]])
            step *= 2
        return np.minimum(low[at], low[at + left - step])


def smallest(group: np.ndarray, id: np.ndarray) -> np.ndarray:
    """For each item the smallest id of its group."""
    low = np.full(int(group.max()) + 1 if len(group) else 0, LAST)
    np.minimum.at(low, group, id)
    return low[group]


def spans(at: np.ndarray, width: int, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (sorted) as runs: the index of the first window of each, where it begins, and where its words end."""
    if not len(at):
        return at, at, at
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (apart[1:] != apart[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)] - 1
    return first, at[first], at[last] + width


def _covered(words: Words, at: np.ndarray, width: int, id: np.ndarray, mark: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Spans of the windows ``at``, as (id, mark, int32 pairs) for each document.  id, mark, start: of each text."""
    _, lo, hi = spans(at, width, words.text[at])
    text = words.text[lo]
    pairs = np.stack([lo - words.first[text] + start[text], hi - words.first[text] + start[text]], axis=1).astype("<i4")
    order = np.lexsort((mark[text], id[text]))
    text, pairs = text[order], pairs[order]
    cut = np.flatnonzero(np.r_[True, (id[text[1:]] != id[text[:-1]]) | (mark[text[1:]] != mark[text[:-1]])]) if len(text) else np.zeros(0, np.int64)
    for a, b in zip(cut, np.r_[cut[1:], len(text)]):
        yield int(id[text[a]]), int(mark[text[a]]), pairs[a:b].tobytes()


def _parts(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[tuple[list[int], list[int], list[list[bytes]]]]:
    """Rows (id, mark, text) as ids, marks and lists of words of about ``together`` bytes."""
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for b in batches:
        for i, m, x in zip(*(b.column(k).to_pylist() for k in (0, 1)), b.column(2).cast(pa.binary()).to_pylist()):
            for to, what in zip(held, (LAST if i is None else i, m, (x or b"").split())):
                to.append(what)
            size += len(x or b"")
            if size >= together:
                yield held
                held, size = ([], [], []), 0
    if held[0]:
        yield held


def _slots(width: int, slots: int, limits: Limits):
    """Rows (id, mark, text): for each part and segment the slots (16 bits each) of its minimisers, twice if two rows have them."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, lists in _parts(batches, limits.together):
            words = Words(lists)
            at = words.windows(width)
            if not len(at):
                continue
            slot = (words.minimisers(at, width) & np.uint64(slots - 1)).astype(np.int64)
            text = words.text[at]
            new = np.r_[True, (slot[1:] != slot[:-1]) | (text[1:] != text[:-1])]
            pair = np.unique(slot[new] * len(lists) + text[new]) // len(lists)
            # the first two of each slot
            pair = pair[np.r_[True, True, pair[2:] != pair[:-2]][: len(pair)]]
            segment = pair // limits.segment
            cut = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            low = (pair % limits.segment).astype("<u2")
            data = [low[a:b].tobytes() for a, b in zip(cut.tolist(), np.r_[cut[1:], len(pair)].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(segment[cut]), pa.array(data, pa.binary())], names=["segment", "data"])

    return over


def _marked(limits: Limits):
    """Rows (segment, data), sorted by segment: for each segment the bits of the slots that came twice, and of the hot ones."""

    def bits(segment: int, seen: np.ndarray) -> tuple[int, bytes, bytes]:
        hot = np.flatnonzero(seen > max(limits.hot, limits.even * seen.sum() / max(1, np.count_nonzero(seen))))
        return segment, np.packbits(seen > 1).tobytes(), (segment * limits.segment + hot).astype("<u4").tobytes()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, np.zeros(limits.segment, np.int64)
        done: list[tuple[int, bytes, bytes]] = []
        for b in batches:
            for segment, data in zip(*(x.to_pylist() for x in b.columns)):
                if segment != last:
                    if last is not None:
                        done.append(bits(last, seen))
                    last, seen = segment, np.zeros(limits.segment, np.int64)
                seen += np.bincount(np.frombuffer(data, "<u2"), minlength=limits.segment)
        if last is not None:
            done.append(bits(last, seen))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["segment", "bits", "hot"])

    return over


def shared_slots(df: DataFrame, width: int, slots: int, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """A bit map of ``slots`` bits, those of minimisers that two rows (id, mark, text) or more have, and the hot slots."""
    found = df.mapInArrow(_slots(width, slots, limits), "segment long, data binary").repartition("segment").sortWithinPartitions("segment")
    out, every = np.zeros(max(slots, limits.segment) // 8, np.uint8), [np.zeros(0, "<u4")]
    for segment, bits, hot in zip(*(x.to_pylist() for x in found.mapInArrow(_marked(limits), "segment long, bits binary, hot binary").toArrow().columns)):
        out[segment * limits.segment // 8 :][: limits.segment // 8] = np.frombuffer(bits, np.uint8)
        every.append(np.frombuffer(hot, "<u4"))
    return out, np.sort(np.concatenate(every))


def _pack(width: int, buckets: int, slots: int, bits, limits: Limits):
    """Rows (id, mark, text): packed super-k-mers (bucket, data; id null) and spans settled here (id, mark, data)."""

    def part(id: list[int], mark: list[int], lists: list[list[bytes]]) -> pa.RecordBatch:
        words, ids, marks = Words(lists), np.array(id, np.int64), np.array(mark, np.int64)
        at = words.windows(width)
        own = ids[words.text[at]]
        open_ = own == smallest(words.alike(at, width), own) if len(at) else np.zeros(0, bool)
        settled = list(_covered(words, at[~open_], width, ids, marks, np.zeros(len(ids), np.int64)))
        at = at[open_]
        low = words.minimisers(at, width) if len(at) else np.zeros(0, np.uint64)
        slot = (low & np.uint64(slots - 1)).astype(np.int64)
        marked, hot_slots = bits.value
        shared = (marked[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)
        at, low, slot = at[shared], low[shared], slot[shared]
        if len(hot_slots):
            hot = hot_slots[np.minimum(np.searchsorted(hot_slots, slot), len(hot_slots) - 1)] == slot
            low[hot] = words.keys(at[hot], width)
        first, lo, hi = spans(at, width, low)
        to = (low[first] % np.uint64(buckets)).astype(np.int64) if len(at) else first
        order = np.argsort(to, kind="stable")
        lo, hi, to = lo[order], hi[order], to[order]
        text = words.text[lo]
        flat = [w for x in lists for w in x]
        ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)) + 1)
        joined = b" ".join(flat)
        begin = np.r_[0, ends][lo].tolist()
        end = (ends[hi - 1] - 1).tolist() if len(hi) else []
        press = zstandard.ZstdCompressor(level=LEVEL)
        data = []
        cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
        for a, b in zip(cut.tolist(), np.r_[cut[1:], len(to)].tolist()):
            t = text[a:b]
            # small differences press well
            head = np.diff(np.stack([ids[t], marks[t], lo[a:b] - words.first[t]]), axis=1, prepend=0).astype("<i8").T.copy().view(np.uint8).reshape(-1, 8).T.tobytes()
            strings = b"\n".join([joined[x:y] for x, y in zip(begin[a:b], end[a:b])])
            data.append((b - a).to_bytes(4, "little") + press.compress(head + strings))
        n, m = len(data), len(settled)
        return pa.RecordBatch.from_arrays([
            pa.array(np.r_[to[cut], [(x[0] * 0x9E3779B1 + x[1]) % buckets for x in settled]].astype(np.int64)),
            pa.array([None] * n + [x[0] for x in settled], pa.int64()),
            pa.array([None] * n + [x[1] for x in settled], pa.int64()),
            pa.array(data + [x[2] for x in settled], pa.binary()),
        ], names=["bucket", "id", "mark", "data"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _parts(batches, limits.together):
            yield part(*held)

    return over


def _count(width: int, limits: Limits):
    """Rows (bucket, id, mark, data), sorted by bucket: spans (id, mark, data) of all windows that an earlier document has."""

    def unpack(n: int, raw: bytes) -> tuple[np.ndarray, list[bytes]]:
        """(id, mark, start) of strings, and the strings."""
        return np.cumsum(np.frombuffer(raw, np.uint8, 24 * n).reshape(8, 3 * n).T.copy().view("<i8").reshape(n, 3).T, axis=1), raw[24 * n :].split(b"\n")

    def settle(heads: np.ndarray, strings: list[bytes], on: int | None = None) -> tuple[list[tuple[int, int, bytes]], np.ndarray, list[bytes]]:
        """The spans of windows that a smaller id has, and, as packed strings, all other windows of the bucket ``on``."""
        id, mark, start, of = heads
        lists = [x.split() for x in strings]
        words = Words(lists)
        at = words.windows(width)
        own = id[words.text[at]]
        later = own > smallest(words.alike(at, width), own)
        rows = list(_covered(words, at[later], width, id, mark, start))
        if on is None:
            return rows, heads[:, :0], []
        at = at[~later & (of[words.text[at]] == on)]
        _, lo, hi = spans(at, width, words.text[at])
        text = words.text[lo]
        lo, hi = lo - words.first[text], hi - words.first[text]
        left = [b" ".join(lists[t][a:b]) for t, a, b in zip(text.tolist(), lo.tolist(), hi.tolist())]
        return rows, np.stack([id[text], mark[text], start[text] + lo, of[text]]), left

    def out(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["id", "mark", "data"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, strings, size, most, last = [], [], 0, limits.together, None
        for b in batches:
            done = []
            for to, id, mark, data in zip(*(x.to_pylist() for x in b.columns)):
                if id is not None:
                    done.append((id, mark, data))
                    continue
                if size >= most:
                    rows, head, strings = settle(np.concatenate(heads, axis=1), strings, to if to == last else None)
                    yield out(rows)
                    heads = [head]
                    size = sum(map(len, strings)) + 32 * len(strings)
                    most = max(limits.together, 2 * size)
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(data[4:])
                n = int.from_bytes(data[:4], "little")
                head, more = unpack(n, raw)
                heads.append(np.vstack([head, np.full(n, to)]))
                strings += more
                size, last = size + len(raw), to
            if done:
                yield out(done)
        if strings:
            yield out(settle(np.concatenate(heads, axis=1), strings)[0])

    return over


def repeats(df: DataFrame, width: int = 13) -> DataFrame:
    """Of rows (id, mark, text): (id, mark, spans), spans a list of int32 pairs (first word, word after the last) to remove."""
    small_batches(df.sparkSession)
    size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    df = df.select("id", "mark", "text")
    limits = Limits(TOGETHER, SEGMENT, HOT, EVEN)  # as they are here, in all tasks
    slots = min(MOST_SLOTS, max(SEGMENT, 1 << int(size * SLOTS_PER_BYTE).bit_length()))
    bits = df.sparkSession.sparkContext.broadcast(shared_slots(df, width, slots, limits))
    packed = df.mapInArrow(_pack(width, buckets, slots, bits, limits), "bucket long, id long, mark long, data binary")
    met = packed.repartition("bucket").sortWithinPartitions("bucket")
    found = met.mapInArrow(_count(width, limits), "id long, mark long, data binary")
    return found.groupBy("id", "mark").agg(F.collect_list("data").alias("spans"))


def keep_mask(n_words: int, found: list[bytes] | None) -> np.ndarray:
    step = np.zeros(n_words + 1, np.int64)
    if found:
        pairs = np.frombuffer(b"".join(found), "<i4").reshape(-1, 2)
        np.add.at(step, pairs[:, 0], 1)
        np.add.at(step, pairs[:, 1], -1)
    return np.cumsum(step[:-1]) == 0


def judged(df: DataFrame, id: str = "doc_id", text: str = "text", width: int = 13, texts: bool = True) -> DataFrame:
    """For each row of ``df``: its columns but the text as a struct ``row``, none (the text is null), n_words, n_removed,
    kept_sha256 (of the words left, joined by a space) and, if wanted, kept_text.

    kept_text is the text without the removed words and the white space after them; a text that loses none is unchanged.
    """
    if not isinstance(df.schema[id].dataType, IntegralType):
        raise TypeError(f"ids must be whole numbers, as documents are compared by them, but {id} is {df.schema[id].dataType.simpleString()}")
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    rows = df.select(F.struct(F.col(f"`{text}`").isNull().alias("no text"), *others).alias("row"), F.col(id).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    # only rows of equal ids need a mark of their text to be told apart
    twice = not rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    rows = rows.withColumn("mark", F.xxhash64("text") if twice else F.lit(0).cast("long"))
    gone = repeats(rows.select("id", "mark", "text"), width).select(F.col("id").alias("of_id"), F.col("mark").alias("of_mark"), "spans")
    on = (F.coalesce("id", F.lit(LAST)) == F.col("of_id")) & (F.col("mark") == F.col("of_mark"))
    slim = rows.join(gone, on, "left").select("row", F.col("row").getField("no text").alias("none"), "text", "spans")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, sha, left = [], [], [], []
            for x, found in zip(b.column(2).cast(pa.binary()).to_pylist(), b.column(3).to_pylist()):
                words = x.split()
                keep = keep_mask(len(words), found)
                kept = words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()]
                n.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                if texts:
                    left.append(x if len(kept) == len(words) else _without(x, words, keep))
            new = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            new += [pa.array(left, pa.binary()).cast(pa.string())] if texts else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *new], names=["row", "none", *(x.name for x in added)])

    added = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())]
    added += [StructField("kept_text", StringType())] if texts else []
    return slim.mapInArrow(over, StructType([*slim.schema.fields[:2], *added]))


def _without(text: bytes, words: list[bytes], keep: np.ndarray) -> bytes:
    """The text without the words that go, and without the white space after each."""
    out, at = [], 0
    begin = []
    for w in words:
        at = text.index(w, at)
        begin.append(at)
        at += len(w)
    begin.append(len(text))
    change = np.flatnonzero(np.diff(np.r_[False, keep, False].astype(np.int8))).reshape(-1, 2).tolist()
    for a, b in change:
        out.append(text[begin[a] : begin[b]])
    return b"".join(out).rstrip()


def dedup(df: DataFrame, id: str = "doc_id", text: str = "text", width: int = 13) -> DataFrame:
    """``df`` with the repeated passages cut out of ``text``; rows that keep no word go.  ``n_chars``, if there, follows."""
    rows = judged(df, id, text, width).where("none OR n_words = 0 OR n_removed < n_words")
    new = F.when(~F.col("none"), F.col("kept_text"))
    cols = []
    for c in df.columns:
        if c == text:
            cols.append(new.alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row").getField(c)).cast(df.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("row").getField(c).alias(c))
    return rows.select(*cols)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


_WINDOW = " || ' ' || ".join(["x"] + [f"lead(x, {k}) OVER w" for k in range(1, 13)])
ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
flat AS (SELECT doc_id, unnest(words) AS x, unnest(range(len(words))) AS i FROM d),
windows AS (SELECT doc_id, i, {_WINDOW} AS s FROM flat WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
first AS (SELECT s, min(doc_id) AS low FROM windows WHERE s IS NOT NULL GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN first USING (s), range(13) AS r(k) WHERE low < doc_id),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS s FROM flat ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
