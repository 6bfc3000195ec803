"""Centroid clustering of integer vectors: k-means rounds in exact arithmetic, with partial-distance search.

A vector's components become integers, floor(``SCALE`` * x), so that sums, means and distances are exact and the result does
not depend on how rows are dealt to tasks.  The nearest centroid is searched by partial distances: squared differences are
added up over the dimensions of high variance first, in ``BLOCKS``; a centroid is abandoned for a vector once its partial
distance is strictly above the best so far, and those that survive have all dimensions added.  The best begins with the
centroid that is nearest in the first block.  Equal distances go to the smaller number, as nothing equal is abandoned.

Each round is one pass over the stored vectors.  A task sends its sums for each cluster, so a round shuffles k * (dims + 2)
numbers a task, and the driver gets as many; the centroids (k vectors) go back with the tasks.  No vector is ever shuffled, so a
vector that many rows share costs no more than others.

Defined results: kept are the vectors with exactly ``dims`` components of which none is null, NaN or infinite (a null vector is
not kept).  A null id is ranked last among the starting centroids, and vectors of one id by their components; repeated rows are
kept as rows.  With fewer than k vectors there are as many centroids; an empty table gives no rows.  Equal
centroids are allowed: the one of the larger number stays empty.  A component of ``LIMIT`` or more is an error, as distances could
not be told in 64 bits.  Columns besides are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import stored, table

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Components have to be smaller, in integers; then 64 squares of differences are below 2**63.
LIMIT = 1 << 27
#: Dimensions that are added before it is tested whether centroids can be abandoned; the last block has the rest.
BLOCKS = (8, 8, 16)


@dataclass(frozen=True)
class Centroids:
    """Centroids by number, as integers, and the dimensions in the order in which they are compared."""

    points: tuple[tuple[int, ...], ...]
    order: tuple[int, ...]


def integers(df: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """The kept vectors as rows (id, v) of integers."""
    kind = df.schema[id].dataType

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            long = pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False)
            ids, lists = b.column(0).filter(long), lists.filter(long)
            flat = lists.flatten().cast(pa.float64())
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)  # nulls are NaN here
            fine = np.isfinite(x).all(axis=1)
            x = np.floor(x[fine] * scale)
            if len(x) and np.abs(x).max() >= LIMIT:
                raise ValueError(f"a component times {scale} is {LIMIT} or more: distances would not be exact")
            v = pa.ListArray.from_arrays(np.arange(0, x.size + 1, dims, dtype=np.int32), pa.array(x.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(fine)), v], names=["id", "v"])

    schema = StructType([StructField("id", kind), StructField("v", ArrayType(IntegerType()))])
    return df.select(F.col(id).alias("id"), F.col(vector).alias("v")).mapInArrow(over, schema)


def matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; both have their dimensions in the order of comparison."""
    edges = [0, *np.minimum(np.cumsum(BLOCKS), v.shape[1]).tolist(), v.shape[1]]
    squares = lambda a, b: np.einsum("ij,ij->i", a - b, a - b)
    first = np.stack([squares(v[:, : edges[1]], c[: edges[1]]) for c in centroids], axis=1)
    own = first.argmin(axis=1)
    best, found = first[np.arange(len(v)), own] + squares(v[:, edges[1] :], centroids[own, edges[1] :]), own.copy()
    for k, c in enumerate(centroids):
        live = np.flatnonzero((own != k) & (first[:, k] <= best))
        partial = first[live, k]
        for a, b in zip(edges[1:], edges[2:]):
            partial = partial + squares(v[live, a:b], c[a:b])
            stays = partial <= best[live]
            live, partial = live[stays], partial[stays]
        better = (partial < best[live]) | (k < found[live])
        best[live[better]], found[live[better]] = partial[better], k
    return found, best


def _ordered(centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    order = np.array(centroids.order)
    return order, np.array(centroids.points, np.int64)[:, order]


def dimensions(vectors: DataFrame, dims: int) -> tuple[int, ...]:
    """The dimensions by falling variance over all vectors; they decide how soon centroids are abandoned, not what is found."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(dims), np.zeros(dims)
        for b in batches:
            x = matrix(b.column(0), dims).astype(np.float64)
            n, total, square = n + len(x), total + x.sum(axis=0), square + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array(total), pa.array(square)], names=["dim", "n", "s", "q"])

    rows = vectors.select("v").mapInArrow(over, "dim long, n long, s double, q double").groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    variance = {r["dim"]: r["q"] / r["n"] - (r["s"] / r["n"]) ** 2 for r in rows if r["n"]}
    return tuple(sorted(range(dims), key=lambda d: (-variance.get(d, 0.0), d)))


def totals(vectors: DataFrame, centroids: Centroids) -> dict[int, tuple[int, int, list[int]]]:
    """(vectors, summed distance, sum of each component) of each cluster that is not empty."""
    order, points = _ordered(centroids)
    k, dims = points.shape

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of each cluster the sums of components, then the number of vectors, then the inertia
        total = np.zeros((k, dims + 2), np.int64)
        for b in batches:
            v = matrix(b.column(0), dims)
            own, distance = nearest(v[:, order], points)
            np.add.at(total[:, dims], own, 1)
            np.add.at(total[:, dims + 1], own, distance)
            for j in np.unique(own):
                total[j, :dims] += v[own == j].sum(axis=0)
        full = np.flatnonzero(total[:, dims])
        place = np.tile(np.arange(dims + 2), len(full))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(full, dims + 2)), pa.array(place), pa.array(total[full].ravel())], names=["cluster", "place", "s"])

    # decimals, as sums over all rows may need more than 64 bits
    rows = vectors.select("v").mapInArrow(over, "cluster long, place long, s long").groupBy("cluster", "place").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect()
    got: dict[int, list[int]] = {}
    for r in rows:
        got.setdefault(r["cluster"], [0] * (dims + 2))[r["place"]] = int(r["s"])
    return {j: (x[dims], x[dims + 1], x[:dims]) for j, x in got.items()}


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS) -> Centroids | None:
    """Centroids after ``rounds`` rounds over the rows (id, v) of ``integers``; None without vectors.

    They start as the vectors with the smallest lower-case SHA-256 of ``seed:id``.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.select("v", drawn.alias("drawn")).orderBy(F.asc_nulls_last("drawn"), "v").limit(clusters).collect()
    if not first:
        return None
    found = Centroids(tuple(tuple(r["v"]) for r in first), dimensions(vectors, dims))
    for _ in range(rounds):
        got = totals(vectors, found)
        found = Centroids(tuple(tuple(s // got[j][0] for s in got[j][2]) if j in got else p for j, p in enumerate(found.points)), found.order)
    return found


def assign(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """id, cluster and squared distance of each vector."""
    order, points = _ordered(centroids)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, distance = nearest(matrix(b.column(1), len(order))[:, order], points)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return vectors.select("id", "v").mapInArrow(over, StructType([vectors.schema["id"], StructField("cluster", IntegerType()), StructField("distance", LongType())]))


def _by_cluster(values: dict[int, object], kind: str) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("cluster")).cast(kind)


def cluster(df: DataFrame, id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> tuple[DataFrame, Centroids | None]:
    """(rows of id, cluster, distance, cluster_inertia and inertia; the centroids).  The integers are stored once for all rounds."""
    vectors = stored(integers(df, id, vector, dims, scale), "vectors")
    if (found := fit(vectors, clusters, rounds, seed, dims)) is None:
        return vectors.select("id", *[F.lit(0).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"))]), None
    sums = {j: inertia for j, (_, inertia, _) in totals(vectors, found).items()}
    rows = assign(vectors, found).withColumn("cluster_inertia", _by_cluster(sums, "long")).withColumn("inertia", F.lit(sum(sums.values())).cast("long"))
    return rows, found


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = cluster(table(spark, sf_dir, "embeddings"))
    points = {j: ",".join(map(str, p)) for j, p in enumerate(found.points if found else [()])}
    return rows.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", F.sha2(_by_cluster(points, "string"), 256).alias("centroid_sha256"))


def _oracle() -> str:
    """Rounds of assignment and exact means, each a table; distances are added up in full."""
    nearest_of = lambda r: (
        f"a{r} AS MATERIALIZED (SELECT vec_id, v, arg_min(c, d * {CLUSTERS} + c) AS cluster, min(d) AS d FROM (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, p{r}) GROUP BY vec_id, v)"
    )
    steps = []
    for r in range(ROUNDS):
        steps.append(nearest_of(r))
        steps.append(f"s{r} AS MATERIALIZED (SELECT cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {DIMS + 1}) AS t(i) GROUP BY cluster, i)")
        steps.append(f"m{r} AS MATERIALIZED (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS p FROM s{r} GROUP BY cluster)")
        steps.append(f"p{r + 1} AS MATERIALIZED (SELECT p{r}.c, coalesce(m{r}.p, p{r}.p) AS p FROM p{r} LEFT JOIN m{r} ON m{r}.cluster = p{r}.c)")
    steps.append(nearest_of(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
p0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, v AS p FROM kept QUALIFY c < {CLUSTERS}),
{', '.join(steps)}
SELECT vec_id, cluster::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN p{ROUNDS} ON c = cluster"""


ORACLE = _oracle()
