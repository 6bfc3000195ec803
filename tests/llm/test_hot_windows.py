"""Substring dedup where minimisers are hot, buckets are settled again and again, and hashes meet."""

import random

import numpy as np
import pytest

from tidemark.llm import substring_dedup
from test_queries import left_words, words


def texts(seed):
    drawn = random.Random(seed)
    common = [" ".join(f"c{drawn.randrange(30)}" for _ in range(n)) for n in (13, 14, 40, 90)]
    out = {}
    for i in range(160):
        own = [f"w{drawn.randrange(12)}" for _ in range(drawn.randrange(60))]
        for _ in range(drawn.randrange(4)):
            at = drawn.randrange(len(own) + 1)
            own[at:at] = drawn.choice(common).split()
        out[i] = " ".join(own)
    return out


@pytest.mark.parametrize("hot, together, slots", [(64, 5_000_000, 1 << 28), (0, 1000, 1 << 16), (1, 200, 1 << 28), (2, 5000, 256)])
def test_hot_minimisers_and_small_parts(spark, monkeypatch, hot, together, slots):
    for name, value in (("HOT", hot), ("EVEN", 0.5), ("TOGETHER", together), ("MOST_SLOTS", slots), ("SEGMENT", min(1 << 16, slots))):
        monkeypatch.setattr(substring_dedup, name, value)
    docs = texts(hot)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["kept_text"] for r in substring_dedup.judged(frame).select("row.doc_id", "kept_text").collect()}
    want = left_words(docs)
    assert {i: words(t) for i, t in got.items()} == want and sum(map(len, want.values())) < sum(len(words(t)) for t in docs.values())


def test_different_windows_of_one_key():
    """Windows are compared word by word where their hashes agree."""
    held = substring_dedup.Words([[b"a", b"b", b"c"], [b"a", b"b", b"d"], [b"a", b"b", b"c"]])
    held.h = np.zeros(len(held.ids), np.uint64)
    kind = held.alike(held.windows(3), 3)
    assert kind[0] == kind[2] != kind[1]
