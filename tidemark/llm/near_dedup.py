"""The verified form of ``simhash``: links at a Jaccard similarity of 0.8 or more of word shingles, and their classes.

The steps are those of ``simhash``: fingerprints, BK-trees that are searched along their edges, components.  A text's set has
a 64-bit hash for each of its runs of five words, and its fingerprint is the SimHash of the set, of 512 bits instead of 64.
Of the first 256, which the trees compare, 39 (15 %) differ at a similarity of 0.8, and 128 between unrelated texts, so that a
radius of ``RADIUS`` tells them apart, which one of 24 of 64 bits doesn't.

No blocks of bits are sure to be equal at such a radius.  So each fingerprint goes to ``tables`` of buckets, each of the bits
at places drawn from the 512: as many bits as leave about ``BUCKET`` fingerprints in a bucket, and as many tables as lose a link
at the similarity itself with a probability of ``MISS`` at most (closer ones far less often).  Inside a bucket, BK-trees are
searched by ``simhash``, with its shards of large buckets.  What links lead to there is a class of candidates, to whose place
each text goes once; there each link is decided by the fingerprints and then by the sets themselves.  A search takes a set's neighbours
out of those not yet reached, so a class of near copies costs few comparisons and returns a spanning forest, never its pairs.
A class of over ``SHARD`` sets is dealt into shards, of which all pairs are searched, so that no task holds more than two
shards and no link is lost.

Defined results: null and blank texts have the same set, and one of under five words has one shingle, all its words;
repeated rows share their set; a null id counts as largest; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import acos, comb, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemark.llm.common import forget, small_batches, stored, text_key
from tidemark.llm.components import components
from tidemark.llm.simhash import apart, linked

#: Bits of a fingerprint, the columns with its words, and those of them that are compared.
BITS, WORDS = 512, [f"fp{i}" for i in range(8)]
COMPARED = WORDS[:4]
#: The stage's words of a shingle, similarity, and radius of 256 bits: at 0.8, 39 bits differ with a deviation of 6; of sets of
#: four and five shingles, the pairs that differ most, 48.
SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 72
#: Fingerprints of a bucket, links at the similarity that may be lost, and bits whose tables would be too many.
BUCKET, MISS, MOST_BITS = 128, 4e-4, 40
#: Sets of at most FEW shingles differ by up to FEW_MORE more of the bits than large ones, others by up to MORE (counted over all
#: sizes at 0.8), and have tables of their own for that.
FEW, FEW_MORE, MORE = 5, 0.04, 0.01
#: Sets of a class that are searched at once; larger classes are dealt.
SHARD = 512
#: Shingles whose bits are counted together, in blocks that a byte can count.
PIECE, BLOCK = 10_200, 255

def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The hashes of a UTF-8 text's shingles, ascending and distinct; never empty."""
    words = (text or b"").lower().split()  # bytes: only A-Z is lowered, only ASCII white space cuts
    runs = list(map(b" ".join, zip(*(words[i:] for i in range(width))))) or [b" ".join(words)]
    return np.unique(np.frombuffer(b"".join(map(xxhash.xxh64_digest, runs, repeat(42))), ">u8").astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Another hash of hashes, in place."""
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(times)
    x ^= x >> np.uint64(31)
    return x


_PLUS = np.arange(1, len(WORDS) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def simhash(found: np.ndarray) -> np.ndarray:
    """The bits that over half of a set's hashes have, as words; each hash is mixed to the bits of all words."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(found), PIECE):
        bits = np.unpackbits(mixed(found[i : i + PIECE, None] + _PLUS).view(np.uint8), axis=1)
        whole = len(bits) // BLOCK * BLOCK
        if whole:
            ones += bits[:whole].reshape(-1, BLOCK, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(found)).view(np.uint64)


def lost(tables: int, bits: int, share: float) -> float:
    """The probability that no table of ``bits`` drawn bits has a pair in one bucket if a ``share`` of all bits differ on average."""
    odds = [comb(BITS, d) * share**d * (1 - share) ** (BITS - d) for d in range(BITS + 1)]
    return sum(p * (1 - comb(BITS - d, bits) / comb(BITS, bits)) ** tables for d, p in enumerate(odds))


def tables(n: int, similarity: float) -> tuple[np.ndarray, int]:
    """Of ``n`` fingerprints: the bits of each table, as words, and how many of the tables are for sets of more than FEW shingles."""
    bits = min(max(n - 1, 0) // BUCKET, 1 << MOST_BITS).bit_length()
    share = acos(2 * similarity / (1 + similarity)) / pi
    sizes = []
    for more in (MORE, FEW_MORE):
        high = 1
        while lost(high, bits, min(share + more, 0.5)) > MISS:
            high *= 2
        low = high // 2  # loses too many, or is none
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if lost(mid, bits, min(share + more, 0.5)) > MISS else (low, mid)
        sizes.append(high)
    drawn = np.random.default_rng(8).permuted(np.tile(np.arange(BITS) < bits, (max(sizes), 1)), axis=1)
    return np.packbits(drawn, axis=1).view(np.uint64), sizes[0]


def candidates(sets: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Of sets (WORDS, few): edges (a, b), by first words, a spanning forest of the fingerprints within the radius in each bucket."""
    # sets that are equal in what is compared have one place in the trees
    rest = [x for x in WORDS if x not in COMPARED]
    prints = sets.groupBy(*COMPARED).agg(F.min(F.struct(*rest)).alias("rest"), F.max("few").alias("few"))
    prints = stored(prints.select(*COMPARED, "rest.*", "few"), "prints")
    mask, most = tables(prints.count(), similarity)
    number = mixed(np.arange(1, len(mask) + 1, dtype=np.uint64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(len(WORDS))], axis=1)
            few = b.column(len(WORDS)).to_numpy(zero_copy_only=False).astype(bool)
            for some, upto in ((few, len(mask)), (~few, most)):
                # 100 fingerprints in all tables are some 10,000 rows
                for part in np.split(fp[some], range(100, int(some.sum()), 100)):
                    key = np.repeat(number[None, :upto], len(part), axis=0)
                    for k in range(len(WORDS)):
                        key = mixed(key ^ (part[:, k, None].view(np.uint64) & mask[:upto, k]))
                    words = [pa.array(np.repeat(part[:, k], upto)) for k in range(len(COMPARED))]
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64) >> 32), *words], names=["bucket", *COMPARED])

    # buckets that collide only mean more comparisons
    rows = prints.mapInArrow(deal, ", ".join(f"{x} long" for x in ["bucket", *COMPARED]))
    return linked(rows, COMPARED, radius)


def forest(sets: list[np.ndarray], radius: int, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets, as pairs of their numbers."""
    prints = np.array([simhash(x)[: len(COMPARED)] for x in sets], np.uint64)
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    known, code = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(code, np.cumsum(size)[:-1])
    mark = np.zeros(len(known), np.int64)
    left, out, reached = np.arange(len(sets)), [], []
    while len(left):
        x = reached.pop() if reached else int(left[0])
        left = left[left != x]
        near = left[apart(prints[left], prints[x]) <= radius]
        if not len(near):
            continue
        mark[parts[x]] = 1
        both = np.add.reduceat(mark[np.concatenate([parts[y] for y in near])], np.cumsum(size[near]) - size[near])
        mark[parts[x]] = 0
        found = near[both >= similarity * (size[near] + size[x] - both) - 1e-9]
        out += [(x, y) for y in found.tolist()]
        reached += found.tolist()
        left = np.setdiff1d(left, found, assume_unique=True)
    return out


def _linker(radius: int, shingle: int, similarity: float):
    """Over rows (class, a, b, set, text) sorted by the first three: spanning edges (a, b) of each group's links."""

    def edges(names: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        got = forest(sets, radius, similarity) if len(sets) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([names[e[k]] for e in got], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, sets = None, [], []
        for batch in batches:
            for *group, one, text in zip(*(batch.column(k).to_pylist() for k in range(4)), batch.column(4).cast(pa.binary()).to_pylist()):
                if group != at:
                    if len(sets) > 1:
                        yield edges(names, sets)
                    at, names, sets = group, [], []
                names.append(one)
                sets.append(shingles(text, shingle))
        yield edges(names, sets)

    return over


def with_sets(df: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with a hash of the text's set (``set``, a long), the WORDS of its fingerprint, and whether it is of FEW shingles."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x, shingle) for x in b.column(at).cast(pa.binary()).to_pylist()]
            names = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
            prints = np.array([simhash(x) for x in sets], np.uint64).reshape(-1, len(WORDS)).view(np.int64)
            few = pa.array([len(x) <= FEW for x in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names), *map(pa.array, prints.T.copy()), few], names=[*b.schema.names, "set", *WORDS, "few"])

    return df.mapInArrow(add, StructType([*df.schema.fields, *[StructField(x, LongType()) for x in ("set", *WORDS)], StructField("few", BooleanType())]))


def links(sets: DataFrame, texts: DataFrame, radius: int, shingle: int, similarity: float) -> DataFrame:
    """Of distinct sets (set, class, n of the class, and id, raw, size of a row) and rows (id, text): edges (a, b), a spanning
    forest of the links in each class."""
    shards = F.ceil(F.col("n") / SHARD).cast("long")
    rows = sets.withColumn("mine", F.pmod(F.xxhash64("set", F.lit(7)), shards))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)))
    rows = rows.select("class", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "set")
    wanted = sets.select("set", F.col("id").alias("of_id"), F.col("raw").alias("of_raw"), F.col("size").alias("of_size"))
    texts = texts.select("id", "text", *text_key(F.col("text")))
    on = texts["id"].eqNullSafe(wanted["of_id"]) & (texts["raw"] == wanted["of_raw"]) & (texts["size"] == wanted["of_size"])
    # rows of a few numbers; broadcast, they spare the other texts a shuffle
    texts = texts.join(F.broadcast(wanted) if wanted.count() <= 500_000 else wanted, on).groupBy("set").agg(F.min("text").alias("text"))
    rows = rows.join(texts, "set").select("class", "a", "b", "set", "text")
    return rows.repartition("class", "a", "b").sortWithinPartitions("class", "a", "b").mapInArrow(_linker(radius, shingle, similarity), "a long, b long")


def classes(df: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """For each row: id, raw and size (of the text), and root, a hash of a set that names the class."""
    texts = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows = with_sets(texts.select("*", *text_key(F.col("text"))), "text", shingle)
    rows = stored(rows.drop("text"), "sets")
    one = F.struct(F.col("id").isNull().alias("none"), "id", "raw", "size")
    same = [F.first(x).alias(x) for x in (*WORDS, "few")]
    sets = rows.groupBy("set").agg(F.min(one).alias("one"), *same)
    sets = stored(sets.select("set", *WORDS, "few", "one.id", "one.raw", "one.size"), "distinct")
    # a class of candidates has the name of a fingerprint's first word: those that share it are decided by the sets, too
    near = components(candidates(sets, radius, similarity))
    of = sets.join(near, sets[WORDS[0]] == near["node"], "left").select("set", "id", "raw", "size", F.coalesce("root", WORDS[0]).alias("class"))
    of = stored(of, "candidates")
    # stored, so that the rows of a large class are a skewed join, which Spark splits
    large = stored(of.groupBy("class").agg(F.count("*").alias("n")).where("n > 1"), "large")
    of_large = stored(of.join(large, "class"), "of_large")
    root = components(links(of_large, texts, radius, shingle, similarity))
    forget(sets, near, of, large, of_large)
    return rows.select("id", "raw", "size", "set").join(root, rows["set"] == root["node"], "left").select("id", "raw", "size", F.coalesce("root", "set").alias("root"))
