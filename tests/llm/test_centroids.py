"""Centroid clustering against plain arithmetic, and vectors that are not kept."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids


def brute(rows, k, rounds, dims, seed=3, scale=1024):
    """(id, cluster, distance) by Python integers, all distances in full."""
    kept = []
    for id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((id, tuple(int(np.floor(scale * float(x))) for x in v)))
    drawn = sorted(kept, key=lambda r: ((0, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest()) if r[0] is not None else (1, ""), r[1]))
    points = [v for _, v in drawn[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    own = lambda v: min((apart(v, p), j) for j, p in enumerate(points))
    for _ in range(rounds):
        of = [own(v)[1] for _, v in kept]
        for j in set(of):
            mine = [v for (_, v), o in zip(kept, of) if o == j]
            points[j] = tuple(sum(x) // len(mine) for x in zip(*mine))
    return sorted(((id, *own(v)[::-1]) for id, v in kept), key=str), points


def test_search_by_partial_distances():
    """Ties, equal centroids, and any order of dimensions."""
    drawn = np.random.default_rng(1)
    for n, k, wide in ((200, 8, 3), (50, 5, 2), (300, 8, 2000), (1, 1, 5), (0, 3, 5)):
        v, c = drawn.integers(-wide, wide, (n, 64)), drawn.integers(-wide, wide, (k, 64))
        c[-1] = c[0]
        v[: n // 3] = c[drawn.integers(0, k, n // 3)]
        found, best = centroids.nearest(v, c)
        every = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        assert (found == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


@pytest.mark.parametrize("parts", [1, 7])
def test_clusters(spark, parts):
    """Rejected vectors, null and repeated ids, repeated rows, a vector that a third of the rows have, and clashing names."""
    drawn = random.Random(5)
    some = lambda: [drawn.choice((drawn.uniform(-1, 1), -0.5, 0.25)) for _ in range(4)]
    rows = [(i, some()) for i in range(60)] + [(i, [0.5, -0.25, 0.125, 1.0]) for i in range(100, 140)]
    rows += [(3, some()), (3, some()), (None, some()), (None, some()), (7, rows[7][1]), (200, None), (201, []), (202, [1.0] * 3), (203, [1.0] * 5)]
    rows += [(204, [1.0, None, 0.0, 0.0]), (205, [float("nan"), 0.0, 0.0, 0.0]), (206, [0.0, float("inf"), 0.0, 0.0]), (207, [0.0, 0.0, 0.0, float("-inf")])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", *[F.lit(c).alias(c) for c in ("id", "v", "cluster", "distance", "s", "n")]).repartition(parts)
    got, found = centroids.cluster(df, clusters=5, rounds=4, dims=4)
    want, points = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5, 4, 4)
    got = got.collect()
    assert sorted(((r["id"], r["cluster"], r["distance"]) for r in got), key=str) == want and list(found.points) == points
    assert {r["inertia"] for r in got} == {sum(d for *_, d in want)}
    assert all(r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"]) for r in got)


def test_few_vectors_and_large_components(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<double>")
    got, found = centroids.cluster(df, dims=2)
    assert len(found.points) == 2 and sorted((r["id"], r["distance"], r["inertia"]) for r in got.collect()) == [(1, 0, 0), (2, 0, 0)]
    none, found = centroids.cluster(df.where("vec_id > 5"), dims=2)
    assert found is None and none.columns == got.columns and none.count() == 0
    with pytest.raises(Exception, match="would not be exact"):
        centroids.cluster(spark.createDataFrame([(1, [1e9, 1.0])], "vec_id long, embedding array<double>"), dims=2)[0].collect()


def test_the_query(spark, tmp_path):
    """The registered query at its own parameters over 64 components."""
    drawn = np.random.default_rng(2)
    rows = [(i, drawn.normal(size=64).astype(np.float32).tolist()) for i in range(150)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    want, points = brute(rows, 8, 10, 64)
    got = centroids.op11_centroids(spark, str(tmp_path))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = got.collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str) == want
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, points[r["cluster"]])).encode()).hexdigest() for r in got)
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert centroids.op11_centroids(spark, f"{tmp_path}/none").collect() == []
