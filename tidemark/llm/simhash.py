"""SimHash near-duplicates: fingerprints, BK-trees and components.

A fingerprint has 64 bits from the word shingles of a text.  Two fingerprints link at ``radius`` or fewer differing
bits.  They are cut into ``radius + 2`` blocks; linked ones agree in two blocks at least, so each distinct fingerprint
goes, once for each pair of blocks, to the bucket of the bits there.  Inside a bucket a BK-tree (children keyed by the
Hamming distance to their parent) is searched along the edges within the radius only.  A bucket of over ``SHARD``
fingerprints is dealt into shards of about that size; every shard's tree travels to every shard's queries, so that no
task holds more than two shards and no link is lost.  A search ends where a whole subtree is known to be in the query's
component already, so a dense bucket costs few comparisons, and a bucket returns a spanning forest, never its pairs.

Trees are built and searched for many buckets at once, level by level, as numpy arrays.  Fingerprints of several words
of 64 bits (those of ``near_dedup``, the verified form) are searched by the same trees, in buckets of drawn bits.

Defined results: a null or blank text has the fingerprint zero, which links like any other; repeated rows share their
fingerprint; a null id counts as largest; an empty table gives no rows; other columns pass through ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import forget, small_batches, stored, table, text_key, without
from tidemark.llm.components import components

#: Fingerprints in a tree at most; larger buckets have several trees.
SHARD = 1024
#: Fingerprints whose buckets are searched together, and pairs of a search held at once.
TOGETHER, FRONTIER = 100_000, 1_000_000
#: Shingles whose bits are counted together.
PIECE = 50_000


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number."""
    words = (text or b"").lower().split()  # bytes: only A-Z is lowered, only ASCII white space cuts
    if not words:
        return 0
    shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle))))) or [b" ".join(words)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(shingles), PIECE):
        raw = b"".join(map(xxhash.xxh64_digest, shingles[i : i + PIECE], repeat(42)))
        ones += np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str, name: str, shingle: int = 3) -> DataFrame:
    """``df`` with the fingerprint of ``text`` (a signed long) added as ``name``."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(x, shingle) for x in b.column(at).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found.view(np.int64))], names=[*b.schema.names, name])

    return df.mapInArrow(add, StructType([*df.schema.fields, StructField(name, LongType())]))


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The differing bits of fingerprints: numbers, or rows of numbers."""
    n = np.bitwise_count(x ^ y)
    return n.astype(np.int64) if n.ndim == 1 else n.sum(axis=-1, dtype=np.int64)


class Forest:
    """One BK-tree for each value of ``tree`` (0, 1, ...); node i holds ``fp[i]``, and the first of a tree is its root."""

    def __init__(self, fp: np.ndarray, tree: np.ndarray):
        self.fp, self.most = fp, 64 * (1 if fp.ndim == 1 else fp.shape[1])
        self.roots = np.unique(tree, return_index=True)[1]
        at = self.roots[tree]  # the node that an item has come to
        todo = np.setdiff1d(np.arange(len(fp)), self.roots, assume_unique=True)
        keys, nodes, self.levels = [], [], []
        while len(todo):
            # all items that reach a node do so in the same round, so the first at a distance is the child there
            key = at[todo] * (self.most + 1) + apart(fp[todo], fp[at[todo]])
            found, first, where = np.unique(key, return_index=True, return_inverse=True)
            child = todo[first]
            self.levels.append((child, found // (self.most + 1)))
            keys.append(found)
            nodes.append(child)
            rest = np.ones(len(todo), bool)
            rest[first] = False
            at[todo] = child[where]
            todo = todo[rest]
        key, node = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, nodes))
        order = np.argsort(key)
        self.key, self.node = key[order], node[order]

    def spread(self, label: np.ndarray) -> None:
        """Note, for each node, the smallest and largest label in its subtree."""
        self.low, self.high = label[: len(self.fp)].copy(), label[: len(self.fp)].copy()
        for child, parent in reversed(self.levels):
            np.minimum.at(self.low, parent, self.low[child])
            np.maximum.at(self.high, parent, self.high[child])

    def search(self, fp: np.ndarray, root: np.ndarray, label: np.ndarray, radius: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes before ``own`` (a query's own node) within the radius, without subtrees that have the
        query's label throughout."""
        query, node, hits = np.arange(len(fp)), root, []
        while len(query):
            # children come after their parents, so the rest of the subtree is not before the query either
            new = ((self.low[node] != label[query]) | (self.high[node] != label[query])) & (node < own[query])
            query, node = query[new], node[new]
            far = apart(fp[query], self.fp[node])
            near = far <= radius
            hits.append((query[near], node[near]))
            lo = np.searchsorted(self.key, node * (self.most + 1) + np.maximum(far - radius, 0))
            n = np.searchsorted(self.key, node * (self.most + 1) + np.minimum(far + radius, self.most), side="right") - lo
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            query, node = np.repeat(query, n), self.node[np.repeat(lo, n) + step]
        return np.concatenate([q for q, _ in hits]), np.concatenate([n for _, n in hits])


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its set) after the sets of a[i] and b[i] are united."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up
    return label


def link(fp: np.ndarray, group: np.ndarray, is_node: np.ndarray, is_query: np.ndarray, radius: int) -> np.ndarray:
    """For each item the index of the smallest item that links lead to, in its group (sorted), from queries to nodes."""
    label = np.arange(len(fp))
    nodes = np.flatnonzero(is_node)
    groups, tree = np.unique(group[nodes], return_inverse=True)
    forest = Forest(fp[nodes], tree)
    queries = np.flatnonzero(is_query & np.isin(group, groups))
    home = np.searchsorted(groups, group[queries])
    size = np.bincount(tree, minlength=len(groups))
    first = np.searchsorted(home, np.arange(len(groups)))
    rank = np.arange(len(queries)) - first[home]
    place = np.full(len(fp), len(fp))  # queries that are no nodes search all of them
    place[nodes] = np.arange(len(nodes))
    for low, high in ((0, 4), (4, 32), (32, 256), (256, len(fp))):
        some = np.flatnonzero((rank >= low) & (rank < high))
        cost = np.cumsum(size[home[some]])
        for part in np.split(some, np.searchsorted(cost, np.arange(FRONTIER, cost[-1], FRONTIER))) if len(some) else []:
            if len(part):
                # labels of nodes, as items
                forest.spread(label[nodes])
                q, n = forest.search(fp[queries[part]], forest.roots[home[part]], label[queries[part]], radius, place[queries[part]])
                label = unite(label, queries[part][q], nodes[n])
    return label


def _linker(radius: int, words: int):
    """Over rows (bucket, a, b, mine, words of fp) sorted by the first three: spanning edges (a, b), by the first words of the
    fingerprints, of what links in each group."""

    def edges(got: np.ndarray) -> pa.RecordBatch:
        bucket, a, b, mine = got[:4]
        fp = (got[4] if words == 1 else np.ascontiguousarray(got[4:].T)).view(np.uint64)
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        group = np.cumsum(new) - 1
        keep = np.bincount(group)[group] > 1
        name, fp, group, a, b, mine = got[4][keep], fp[keep], group[keep], a[keep], b[keep], mine[keep]
        label = link(fp, group, mine == a, mine == b, radius) if len(fp) else np.zeros(0, np.int64)
        up = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(name[up]), pa.array(name[label[up]])], names=["a", "b"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4 + words)]))
            n += batch.num_rows
            if n >= TOGETHER:
                got = np.concatenate(held, axis=1)
                whole = np.flatnonzero((got[:3, 1:] != got[:3, :-1]).any(axis=0))  # the last group may go on
                if len(whole):
                    yield edges(got[:, : whole[-1] + 1])
                    got = got[:, whole[-1] + 1 :]
                held, n = [got], got.shape[1]
        if n:
            yield edges(np.concatenate(held, axis=1))

    return over


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Of distinct fingerprints (fp long): edges (a, b), a spanning forest of the links in each bucket."""
    blocks = radius + 2
    edge = [64 * i // blocks for i in range(blocks + 1)]
    mask = [((1 << edge[i + 1]) - (1 << edge[i])) for i in range(blocks)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    # the bits of two blocks and the number of the pair of blocks, hashed; buckets that collide only mean more comparisons
    buckets = F.array(*[F.xxhash64(F.col("fp").bitwiseAND(F.lit(signed(mask[i] | mask[j]))), F.lit(k)) for k, (i, j) in enumerate(combinations(range(blocks), 2))])
    return linked(prints.select("fp", F.explode(buckets).alias("bucket")), ["fp"], radius)


def linked(rows: DataFrame, words: list[str], radius: int) -> DataFrame:
    """Of rows (bucket, words of a fingerprint): edges (a, b), by first words, a spanning forest of the links in each bucket."""
    sizes = stored(rows.groupBy("bucket").agg(F.count("*").alias("n")).where(f"n > {SHARD}"), "sizes")
    # at most 10 / SHARD of the fingerprints are such buckets: small enough to broadcast up to a billion fingerprints
    rows = rows.join(F.broadcast(sizes) if sizes.count() <= 1_000_000 else sizes, "bucket", "left")
    shards = F.ceil(F.col("n") / SHARD).cast("long")
    rows = rows.withColumn("mine", F.when(F.col("n").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*words, F.lit(7)), shards)).cast("long"))
    rows = rows.withColumn("other", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), shards - 1))))
    rows = rows.select("bucket", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", *words)
    return rows.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b", "mine", *words).mapInArrow(_linker(radius, len(words)), "a long, b long")


def classes(df: DataFrame, id: str = "doc_id", text: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """For each row: id, raw and size (of the text), fp, root (a fingerprint that names the class), component (the smallest
    id that links lead to)."""
    rows = with_fingerprint(df.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", "fp", shingle)
    rows = stored(rows.select("id", "fp", *text_key(F.col("text"))), "prints")
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    root = components(links(prints.select("fp"), radius))
    known = stored(prints.join(root, prints["fp"] == root["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    least = stored(known.groupBy("root").agg(F.min("first").alias("component")), "least")
    named = stored(known.join(least, "root").select("fp", "root", "component"), "named")
    forget(prints, known, least, root)
    return rows.join(named, "fp")


def dedup(df: DataFrame, id: str = "doc_id", text: str = "text", radius: int = 3, shingle: int = 3, similarity: float | None = None) -> DataFrame:
    """One row of each class, with the columns of ``df``: of the smallest id, and of its texts that of the smallest hash.

    With a ``similarity`` documents link not by fingerprints alone but if so much of their shingles' union is in both:
    fingerprints within ``radius`` are then candidates only, and have 256 bits; see ``near_dedup``.
    """
    if similarity is not None:
        from tidemark.llm import near_dedup

        found = near_dedup.classes(df, id, text, radius, shingle, similarity)
    else:
        found = classes(df, id, text, radius, shingle)
    return one_of_each(df, id, text, found)


def one_of_each(df: DataFrame, id: str, text: str, found: DataFrame) -> DataFrame:
    """One row of each class, of rows (id, raw, size, root) of ``df``; classes are decided on narrow rows, by minima."""
    order = F.struct(F.col("id").isNull().alias("none"), "id", "raw", "size")
    found = stored(found.groupBy("root", "id", "raw", "size").agg(F.count("*").alias("m")), "rows")
    win = stored(found.groupBy("root").agg(F.min(order).alias("win"), F.sum("m").alias("all")).where("all > 1"), "winners")
    fate = found.join(win, "root").withColumn("one", order == F.col("win"))
    return without(df, id, text, stored(fate.where("NOT one OR m > 1").select("id", "raw", "size", "one"), "doomed"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))

