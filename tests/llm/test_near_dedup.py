"""The pipeline's near-duplicate stage against brute force on planted edits."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow.parquet as pq

import corpus_pipeline
from tidemark.llm import near_dedup

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def linked(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    return [(i, j) for i, j in combinations(sorted(sets), 2) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]


def firsts(ids, pairs):
    low = {i: i for i in ids}
    for _ in ids:
        changed = False
        for i, j in pairs:
            x = min(low[i], low[j])
            changed |= (low[i], low[j]) != (x, x)
            low[i] = low[j] = x
        if not changed:
            break
    return {i for i in ids if low[i] == i}


def planted(n=120):
    """Documents, and for each a copy of which one word in 60 is another, and a blank and a null one."""
    drawn = random.Random(5)
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()[:n]}
    for i in list(docs):
        w = docs[i].split(" ")
        docs[10_000 + i] = " ".join("changed" + str(k) if drawn.random() < 1 / 60 else x for k, x in enumerate(w))
    return docs | {20_000: "", 20_001: None, 20_002: "one two", 20_003: "one two"}


def kept(spark, docs):
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    out = corpus_pipeline.near(spark, frame, SF)
    assert out.columns == frame.columns
    return {r["doc_id"] for r in out.collect()}


def test_planted_edits(spark):
    docs = planted()
    pairs = linked(docs)
    assert len(pairs) > 50
    assert kept(spark, docs) == firsts(docs, pairs)


def test_bucket_in_several_shards(spark, monkeypatch):
    """A chain in which only neighbours link, in buckets that are dealt."""
    monkeypatch.setattr(near_dedup, "SHARD", 4)
    words = [f"w{i}" for i in range(400)]
    docs = {i: " ".join(words[5 * i : 5 * i + 200]) for i in range(30)} | {100 + i: " ".join(words[:200] + [f"x{i}"]) for i in range(30)}
    assert kept(spark, docs) == firsts(docs, linked(docs))


def test_search_of_a_bucket():
    """Of random sets, some close: the forest joins what the pairs at 0.8 join, and the radius loses none."""
    drawn = np.random.default_rng(4)
    base = [drawn.integers(0, 2**63, 200, dtype=np.uint64) for _ in range(6)]
    sets = [np.unique(np.r_[b[: 200 - k], drawn.integers(0, 2**63, k, dtype=np.uint64)]) for b in base for k in drawn.integers(0, 40, 12)]
    pairs = [(i, j) for i, j in combinations(range(len(sets)), 2) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    assert firsts(range(len(sets)), near_dedup.forest(sets, near_dedup.RADIUS, 0.8)) == firsts(range(len(sets)), pairs) and len(pairs) > 20


def test_nulls_and_clashing_names(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (None, "other words that stand here alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS fp", "'y' AS keys", "'z' AS row")
    out = corpus_pipeline.near(spark, frame, SF)
    assert out.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"], r["fp"], r["keys"], r["row"]) for r in out.collect()) == [(0, rows[3][1], "x", "y", "z"), (1, rows[1][1], "x", "y", "z")]
    assert corpus_pipeline.near(spark, frame.where("false"), SF).count() == 0
