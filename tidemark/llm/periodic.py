"""Periodic run detection in the words of documents: stretches that repeat the same words at least four times in a row.

A run is a stretch of words with smallest period q (words q apart are equal), of at least max(``SHORTEST``, ``TIMES`` * q)
words, that no neighbouring word extends.  Its words that equal the one q later are a stretch of at least m(q) =
max(SHORTEST, TIMES * q) - q places, so every run has a place on the grid of multiples of m(q).  Over all periods these are a
harmonic number of (period, grid point) pairs, about n log n of them.  Pairs whose two words differ are in no run; of all others, of all
documents of a batch at once, the longest common extensions to both sides are found by binary search over prefix hashes
(polynomials modulo 2**64, as NumPy adds them up).  Extensions found by hashes are never too short.  Each run's words are then
compared; where hashes were wrong, the exact extensions are taken instead.  Of runs with equal ends that of the smallest
period stays: a stretch of at least 4q words with period q whose smallest period is p has p | q, and then both have the same ends.

Work and memory are bounded by ``TOGETHER`` bytes of text and ``PAIRS`` pairs at once; one longer text is taken as a whole.  Nothing is
shuffled, so hot documents cost their own words only.

Defined results: a null, empty or blank text has no words and no runs; repeated rows get equal results; an empty table gives no rows;
other columns pass through ``with_runs`` and ``collapse`` whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import small_batches, table

#: Words of the shortest run, and how many periods a run has at least.
SHORTEST, TIMES = 6, 4
#: Bytes of text that are searched together, and pairs of period and grid point.
TOGETHER, PAIRS = 2_000_000, 1_000_000
#: The base of the prefix hashes; odd, so that its powers don't vanish.
BASE = 0x9E3779B97F4A7C15

Run = tuple[int, int, int]  # first word, words, period
RUNS = "array<struct<start:long,length:long,period:long>>"


def hashed(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word code."""
    x = codes.astype(np.uint64) + np.uint64(BASE)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(times)
    return x ^ (x >> np.uint64(31))


def grid(size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, period, place in the document) of all pairs, at most PAIRS at once unless one period of a document has more."""
    periods = size // TIMES
    doc = np.repeat(np.arange(len(size)), periods)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(SHORTEST, TIMES * q) - q
    # places i of the grid with a place i + q in the document
    points = -(-(size[doc] - q) // step)
    fits = np.maximum(SHORTEST, TIMES * q) <= size[doc]
    doc, q, step, points = doc[fits], q[fits], step[fits], points[fits]
    ends = np.cumsum(points)
    for part in np.split(np.arange(len(doc)), np.searchsorted(ends, np.arange(PAIRS, ends[-1], PAIRS)) if len(ends) else []):
        if len(part):
            n = points[part]
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(doc[part], n), np.repeat(q[part], n), k * np.repeat(step[part], n)


def _longest(most: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each pair the longest extension up to ``most`` that is the ``same``, all searched at once; same(pairs, lengths)."""
    low, high = np.zeros_like(most), most.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        mid = (low[open_] + high[open_] + 1) // 2
        fine = same(open_, mid)
        low[open_[fine]] = mid[fine]
        high[open_[~fine]] = mid[~fine] - 1
        open_ = open_[low[open_] < high[open_]]
    return low


def extended(codes: np.ndarray, at: np.ndarray, q: np.ndarray, begin: np.ndarray, end: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, stop) of the stretch of period q around each place, by prefix hashes; at least as long as the exact one."""
    power = np.cumprod(np.r_[np.uint64(1), np.full(len(codes), BASE, np.uint64)], dtype=np.uint64)
    prefix = np.r_[np.uint64(0), np.cumsum(values * power[:-1], dtype=np.uint64)]
    ahead = lambda k, n: (prefix[at[k] + n] - prefix[at[k]]) * power[q[k]] == prefix[at[k] + q[k] + n] - prefix[at[k] + q[k]]
    behind = lambda k, n: (prefix[at[k]] - prefix[at[k] - n]) * power[q[k]] == prefix[at[k] + q[k]] - prefix[at[k] + q[k] - n]
    right, left = _longest(end - at - q, ahead), _longest(at - begin, behind)
    return at - left, at + q + right


def exact(codes: np.ndarray, at: int, q: int, first: int, stop: int) -> tuple[int, int]:
    """The stretch of period q around a place within (first, stop), by the words themselves; the place's own pair is equal."""
    differs = np.flatnonzero(codes[first : stop - q] != codes[first + q : stop]) + first
    k = int(np.searchsorted(differs, at))
    return (int(differs[k - 1]) + 1 if k else first), (int(differs[k]) + q if k < len(differs) else stop)


def runs_of(lists: list[list[bytes]], values: Callable[[np.ndarray], np.ndarray] = hashed) -> list[list[Run]]:
    """The runs of each list of words, by start and period."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    codes = np.fromiter(map(number.__getitem__, chain.from_iterable(lists)), np.int64, int(size.sum()))
    begins = np.cumsum(size) - size
    found = []
    for doc, q, place in grid(size):
        at = begins[doc] + place
        equal = codes[at] == codes[at + q]
        doc, q, at = doc[equal], q[equal], at[equal]
        if len(at):
            first, stop = extended(codes, at, q, begins[doc], begins[doc] + size[doc], values(codes))
            long = stop - first >= np.maximum(SHORTEST, TIMES * q)
            found.append(np.stack([doc[long], first[long], stop[long], q[long], at[long]], axis=1))
    out: list[list[Run]] = [[] for _ in lists]
    every = np.concatenate(found) if found else np.zeros((0, 5), np.int64)
    every = every[np.lexsort(every.T[[3, 2, 1, 0]])]
    kept: dict[tuple[int, int, int], int] = {}
    verified = None
    for doc, first, stop, q, at in every.tolist():
        # larger periods of a stretch that is known are no smallest periods
        if verified == (doc, first, stop):
            continue
        if np.array_equal(codes[first : stop - q], codes[first + q : stop]):
            verified = (doc, first, stop)
        else:
            first, stop = exact(codes, at, q, first, stop)
            if stop - first < max(SHORTEST, TIMES * q):
                continue
        kept[doc, first, stop] = min(q, kept.get((doc, first, stop), q))
    for (doc, first, stop), q in kept.items():
        out[doc].append((first - int(begins[doc]), stop - first, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def greatest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period, then of the smallest start, then period."""
    best = None
    for r in runs:  # by start and period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    drops = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        drops[start + q] += 1
        drops[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drops).tolist()) if not d]


def _searched(texts: list[bytes | None], change: Callable[[int, list[bytes]], list[bytes]] | None = None) -> Iterator[tuple[list[bytes], list[Run]]]:
    """(words, runs) of each text; ``change`` may replace the words of the text of a number."""
    part, size = [], 0
    for i, x in enumerate(texts):
        words = (x or b"").split()  # bytes: cut at exactly [\x20\x09-\x0D]
        part.append(change(i, words) if change else words)
        size += len(x or b"")
        if size >= TOGETHER or i == len(texts) - 1:
            yield from zip(part, runs_of(part))
            part, size = [], 0


def with_runs(df: DataFrame, text: str = "text", name: str = "runs") -> DataFrame:
    """``df`` with the runs of each text (start, length and period in words, by start and period) as ``name``."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)
    kind = pa.list_(pa.struct([pa.field(k, pa.int64()) for k in ("start", "length", "period")]))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("start", "length", "period"), r)) for r in runs] for _, runs in _searched(b.column(at).cast(pa.binary()).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], names=[*b.schema.names, name])

    return df.mapInArrow(over, StructType([*df.schema.fields, StructField(name, StructType.fromDDL(f"x {RUNS}")["x"].dataType)]))


def collapse(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each text that has runs replaced by its words outside repeated periods, joined by one space; others stay as they are."""
    small_batches(df.sparkSession)
    rows = df.select(F.struct("*").alias("row"), F.col(text).alias("text"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(1).cast(pa.binary()).to_pylist()
            new = [b" ".join(collapsed(words, runs)) if runs else x for x, (words, runs) in zip(raw, _searched(raw))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.binary()).cast(pa.string())], names=["row", "text"])

    out = rows.mapInArrow(over, StructType([rows.schema["row"], StructField("text", StringType())]))
    return out.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns])


def planted(id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query: of every tenth document, by the CRC of its id, they repeat from some word on; of a null id they stay."""
    h, n = zlib.crc32(str(id).encode()), len(words)
    if id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    small_batches(spark)
    longs = ("n_runs", "start", "length", "period", "exponent_milli")
    texts = ("runs_sha256", "collapsed_sha256")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for words, runs in _searched(b.column(1).cast(pa.binary()).to_pylist(), lambda i, words: planted(ids[i], words)):
                best = greatest(runs)
                told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                lines = "".join("%d,%d,%d\n" % r for r in runs).encode()
                rows.append((len(runs), *told, hashlib.sha256(lines).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in columns[:5]), *(pa.array(x, pa.string()) for x in columns[5:])], names=["doc_id", *longs, *texts])

    return df.mapInArrow(over, ", ".join([f"doc_id {df.schema['doc_id'].dataType.simpleString()}", *(f"{x} long" for x in longs), *(f"{x} string" for x in texts)]))
