"""The near stage's candidates come from SimHash fingerprints, searched in BK-trees."""

import numpy as np
from test_near_dedup import firsts, kept, linked, planted
from tidemark.llm import near_dedup, simhash


def test_trees_of_several_words():
    """Fingerprints of 256 bits in groups: labels equal those of all pairs, for nodes among themselves and for others' queries."""
    drawn = np.random.default_rng(2)
    flips = np.packbits(drawn.random((300, 256)) < drawn.uniform(0, 0.3, (300, 1)), axis=1).view(np.uint64)
    fp = drawn.integers(0, 1 << 64, (6, 4), np.uint64)[drawn.integers(0, 6, 300)] ^ flips
    group = np.sort(drawn.integers(0, 4, 300))
    for node, query in ((np.ones(300, bool),) * 2, (drawn.random(300) < 0.5,) * 2):
        query = query if query.all() else ~query
        got = simhash.link(fp, group, node, query, near_dedup.RADIUS)
        far = np.bitwise_count(fp[:, None] ^ fp).sum(axis=2)
        ok = (group[:, None] == group) & (query[:, None] & node | node[:, None] & query) & (far <= near_dedup.RADIUS)
        pairs = [(i, j) for i, j in np.argwhere(ok).tolist() if i < j]
        assert len(pairs) > 300 and set(np.flatnonzero(got == np.arange(300)).tolist()) == firsts(range(300), pairs)


def candidates(spark, sets):
    prints = [near_dedup.simhash(x).view(np.int64).tolist() for x in sets]
    frame = spark.createDataFrame([(*p, len(x) <= near_dedup.FEW) for p, x in zip(prints, sets)], ", ".join(f"{x} long" for x in near_dedup.WORDS) + ", few boolean")
    name = [p[0] for p in prints]
    edges = [(r["a"], r["b"]) for r in near_dedup.candidates(frame, near_dedup.RADIUS, 0.8).collect()]
    return name, edges


def test_candidates(spark, monkeypatch):
    """Through many tables of few bits, in buckets that are dealt, too: classes hold all links at 0.8 and join only what is in the radius."""
    monkeypatch.setattr(near_dedup, "BUCKET", 2)
    docs = planted()
    sets = list({x.tobytes(): x for x in (near_dedup.shingles((t or "").encode(), 5) for t in docs.values())}.values())
    similar = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    assert len(similar) > 50
    for shard in (1024, 4):
        monkeypatch.setattr(simhash, "SHARD", shard)
        name, edges = candidates(spark, sets)
        by = {n: near_dedup.simhash(x)[:4] for n, x in zip(name, sets)}
        assert edges and all(np.bitwise_count(by[a] ^ by[b]).sum() <= near_dedup.RADIUS for a, b in edges)
        one = {n: {n} for n in name}
        for a, b in edges:
            if one[a] is not one[b]:
                one[a] |= one[b]
                for n in one[b]:
                    one[n] = one[a]
        assert all(one[name[i]] is one[name[j]] for i, j in similar)


def test_stage_with_many_tables(spark, monkeypatch):
    """Classes equal brute force where each bucket has a few fingerprints, and for texts so long that fingerprints are equal."""
    monkeypatch.setattr(near_dedup, "BUCKET", 2)
    monkeypatch.setattr(simhash, "SHARD", 8)
    words = [f"w{i}" for i in range(4000)]
    docs = planted() | {30_000 + i: " ".join([*words, f"x{i}"]) for i in range(40)}
    # all pairs of texts of four and five shingles, which differ most
    docs |= {40_000 + i: " ".join(f"s{i}y{k}" for k in range(8 + i % 2)) for i in range(10)} | {41_000 + i: " ".join(f"s{i}y{k}" for k in range(9 - i % 2)) for i in range(10)}
    assert kept(spark, docs) == firsts(docs, linked(docs))


def test_tables():
    """The share of links at 0.8 that are lost, counted over drawn pairs, is within what is promised, at any size."""
    drawn = np.random.default_rng(7)
    for n in (100, 5_000, 200_000, 10_000_000):
        mask, most = near_dedup.tables(n, 0.8)
        found = 0
        for _ in range(2000):
            differ = np.packbits(drawn.random(near_dedup.BITS) < 0.1515).view(np.uint64)
            found += ((differ & mask[:most]) == 0).all(axis=1).any()
        assert found >= 2000 * (1 - 2 * near_dedup.MISS)
    assert not near_dedup.tables(1, 0.8)[0].any()  # one bucket
