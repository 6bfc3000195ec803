"""Order-preserving packing of documents into sequences of equal length.

Tokens keep the order of the input partition.  Windows are cut at ends of documents or sentences: among all ways to cut
a stretch, dynamic programming takes the one with the least padding plus penalties, where a cut inside a document costs
as much as ``SENTENCE`` padding tokens.  Only where the next such end is more than a window away can a cut be inside the
sentence, at every ``GRID``-th token from its begin, for ``INSIDE``.  With b the place of a cut and f its cost,
f(j) = min over b(j) - b(i) <= length of f(i) + b(i), plus length - b(j) + penalty(j); the window's minimum is kept in a
monotone queue, so a stretch takes time in proportion to its sentences.

A stretch has ``STRETCH`` tokens or one document; its last, open window goes on into the next stretch, so that only the
last sequence of an input partition is open.  Nothing is shuffled and no task holds more than a stretch.

Defined results: a null text is empty, and every document ends with one end token, so each has a piece; null and
repeated ids and repeated rows are packed like others; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructType

from tidemark.llm.bpe import marker
from tidemark.llm.common import small_batches, table

#: Costs of a cut, in padding tokens: at the end of a sentence inside a document, and inside a sentence longer than a
#: window, where every GRID-th token may be one; FREE stands for none.
SENTENCE, INSIDE, GRID, FREE = 4, 24, 32, -1
#: Tokens that are cut together.
STRETCH = 1_000_000


def cuts(place: list[int], penalty: list[int], length: int) -> list[int]:
    """Of ascending places (the first 0, steps of at most ``length``), those of the cheapest cuts: from 0 to the last."""
    came = [0] * len(place)
    key = [0] * len(place)  # the cost up to a place, and the place
    queue, head = [0], 0  # ascending keys of the places that the window can begin at
    for j in range(1, len(place)):
        b = place[j]
        while b - place[queue[head]] > length:
            head += 1
        i = came[j] = queue[head]
        here = key[j] = key[i] + length + penalty[j]
        while len(queue) > head and key[queue[-1]] >= here:
            queue.pop()
        queue.append(j)
    out = [len(place) - 1]
    while out[-1]:
        out.append(came[out[-1]])
    return [place[i] for i in reversed(out)]


def candidates(sizes: list[int], sentences: list[list[int]], length: int) -> tuple[list[int], list[int]]:
    """Places where documents of these sizes may be cut, and the penalty of each."""
    ends = np.cumsum(np.array(sizes, np.int64))
    total = int(ends[-1])
    cost = np.zeros(total + 1, np.int16)
    inside = np.fromiter(map(len, sentences), np.int64, len(sentences))
    flat = np.fromiter(chain.from_iterable(sentences), np.int64, int(inside.sum()))
    cost[flat + np.repeat(ends - np.array(sizes), inside)] = SENTENCE
    cost[ends] = FREE
    cost[0] = FREE
    known = np.flatnonzero(cost)
    for i in np.flatnonzero(np.diff(known) > length).tolist():
        cost[known[i] + min(GRID, length) : known[i + 1] : min(GRID, length)] = INSIDE
    place = np.flatnonzero(cost)
    penalty = cost[place]
    penalty[penalty == FREE] = 0
    return place.tolist(), penalty.tolist()


class Packer:
    """Documents in, pieces out: (id, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, length: int, first: int):
        self.length, self.sequence = length, first
        self.held: list[tuple] = []  # (id, ids, start of these ids in the document, tokens of the document, ends of sentences)
        self.size = 0

    def add(self, id, ids: bytes, sentences: list[int]) -> list[tuple]:
        n = len(ids) // 4
        self.held.append((id, ids, 0, n, sentences))
        self.size += n
        return self.flush(False) if self.size >= STRETCH else []

    def flush(self, last: bool) -> list[tuple]:
        """Pieces of all windows of what is held but, unless it is the ``last`` stretch, of the open one."""
        sizes = [len(x[1]) // 4 for x in self.held]
        place, penalty = candidates(sizes, [x[4] for x in self.held], self.length)
        cut = cuts(place, penalty, self.length)
        if not last:
            cut.pop()
        out, end, doc, at = [], 0, 0, 0
        for begin, end in zip(cut, cut[1:]):
            offset = 0
            while begin + offset < end:
                id, ids, start, total, _ = self.held[doc]
                n = min(sizes[doc] - at, end - begin - offset)
                out.append((id, start + at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), total, self.sequence, offset))
                offset, at = offset + n, at + n
                if at == sizes[doc]:
                    doc, at = doc + 1, 0
            self.sequence += 1
        rest = self.held[doc:]
        if at:
            id, ids, start, total, sentences = rest[0]
            rest[0] = (id, ids[4 * at :], start + at, total, [x - at for x in sentences if x > at])
        self.held, self.size = rest, self.size - end
        return out


FIELDS = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(df: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", length: int = 2048, end_id: int = 1, control: bool = False) -> DataFrame:
    """One row for each piece of a document in a sequence: FIELDS.  Sequence ids are unique, ascending in a partition.

    ``control``: see ``Encoder``.  By default a document can't place control tokens in the data.  Ids may be of any type.
    """
    small_batches(df.sparkSession)
    end = end_id.to_bytes(4, "little")
    kind = df.schema[id].dataType
    of_ids = to_arrow_type(kind)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences_of = marker(path, pattern, control)
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        out: list[tuple] = []
        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids, sentences = sentences_of((raw or b"").decode(), raw or b"")
                out += packer.add(key, ids + end, sentences)
            if out:
                yield _batch(out, of_ids)
                out = []
        yield _batch(packer.flush(True) if packer.held else [], of_ids)

    schema = StructType().add("id", kind)
    for x in FIELDS[1:]:
        schema.add(x, LongType())
    return df.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(over, schema)


def _batch(rows: list[tuple], of_ids: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if k else of_ids) for k, x in enumerate(columns)], names=FIELDS)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def packed(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    return pack(docs, path, pattern).withColumnRenamed("id", "doc_id")
