"""Periodic runs against a walk over all periods, with wrong hashes, too, and the query's changes and digests."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import periodic


def brute(w):
    """Maximal stretches by walking each period from small to large; equal ends keep their first, smallest, period."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(drawn):
    w = [bytes([97 + drawn.randint(0, drawn.choice([0, 1, 2, 5]))]) for _ in range(drawn.randint(0, 40))]
    period = [bytes([97 + drawn.randint(0, 3)]) for _ in range(drawn.randint(1, 6))]
    return w[: drawn.randint(0, 10)] + period * drawn.randint(0, 9) + w


def test_runs(monkeypatch):
    """All documents of a batch at once, in chunks of any size, and with prefix hashes that are often or always wrong."""
    drawn = random.Random(1)
    hashes = (periodic.hashed, lambda c: c.astype(np.uint64) & np.uint64(1), lambda c: np.zeros(len(c), np.uint64))
    for _ in range(250):
        lists = [some_words(drawn) for _ in range(drawn.randint(0, 5))]
        monkeypatch.setattr(periodic, "PAIRS", drawn.choice([3, 50, 1_000_000]))
        want = [brute(w) for w in lists]
        for values in hashes:
            assert periodic.runs_of(lists, values) == want


def test_long_documents_take_little_more_than_their_length():
    begin = time.time()
    assert periodic.runs_of([[b"a"] * 60_000, []]) == [[(0, 60_000, 1)], []]
    words = [b"%d" % (k * k % 1009 + k // 1009) for k in range(200_000)]
    words[100_000:130_000] = (words[:7_000] * 5)[:30_000]
    assert (100_000, 30_000, 7_000) in [(s, n, q) for s, n, q in periodic.runs_of([words])[0] if q == 7_000]
    assert time.time() - begin < 60


def planted(id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(id).encode()), len(w)
    if id is None or h % 10 or not n:
        return w
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_the_query(spark, tmp_path):
    """Null, blank and repeated rows, null ids, separators that are no white space here, and planted repeats."""
    drawn = random.Random(4)
    rows = [(i, " ".join(x.decode() for x in some_words(drawn))) for i in range(400)]
    rows += [(i, " ".join(f"w{drawn.randint(0, 400)}" for _ in range(drawn.randint(1, 400)))) for i in range(400, 700)]
    rows += [(701, None), (702, ""), (703, " \n\t "), (None, "a b " * 9), (None, None), (704, "x " * 5), (704, "x " * 5), (705, "é b é b é b é b\x0bé b\x0cé b"), (706, "a b c " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1))
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for id, text in rows:
        w = planted(id, text)
        runs = brute(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((id, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest()))
    got = periodic.op13_periodic(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 100 and any(r[1] and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in want if r[0] is not None)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert periodic.op13_periodic(spark, f"{tmp_path}/none").collect() == []


def test_the_operator(spark):
    names = ("row", "runs", "start", "text_", "id")
    rows = [(1, "go on " * 5 + "then stop"), (2, None), (3, "  two   blanks  "), (1, "go on " * 5 + "then stop"), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(c).alias(c) for c in names])
    kept = periodic.collapse(df)
    assert kept.columns == df.columns and all(r[c] == c for r in kept.collect() for c in names)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "go on then stop"), (2, None), (3, "  two   blanks  "), (1, "go on then stop"), (None, "")], key=str)
    found = {r["doc_id"]: [tuple(x) for x in r["found"]] for r in periodic.with_runs(df, name="found").collect()}
    assert found == {1: [(0, 10, 2)], 2: [], 3: [], None: []}
    assert periodic.collapse(df.limit(0)).collect() == [] and periodic.with_runs(df.limit(0), name="found").collect() == []
