"""Null and repeated ids, repeated rows, ties, and columns named like those that operators make: values, for each operator."""

import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, chat, exact_dedup, packing, quality_model, quality_rules, sharding, simhash, substring_dedup
from test_queries import classes, prints, words

PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from a very old oak tree nearby. "
OTHER = "Nobody at the harbour could say when the last of the grey ships had left, or why it had taken all the ropes. "
ROWS = [
    (None, PROSE * 2), (1, PROSE * 2), (1, PROSE * 2), (7, PROSE * 2 + " "), (2, None), (None, None), (None, None), (3, PROSE * 2 + OTHER), (4, OTHER * 2), (4, OTHER),
    (5, ""), (5, "menu | home | about"), (6, "x"), (None, "y"), (None, "y"), (8, "z z z"), (8, "zz z"),
]
CLASH = ["row", "id", "mark", "spans", "n_words", "kept", "digest", "fingerprint", "fp", "raw", "size", "one", "of_id", "component_id", "keep_id", "score", "root", "no", "none"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").select("*", *[F.lit(c).alias(c) for c in CLASH])


def pairs(df, like):
    assert df.columns == like.columns and dict(df.dtypes) == dict(like.dtypes)
    rows = df.collect()
    assert all(r[c] == c for r in rows for c in CLASH)
    return Counter((r["doc_id"], r["text"]) for r in rows)


def low(id):
    return (id is None, id or 0)


def winners(groups):
    """Of rows by group the first in order, once."""
    return Counter(min(g) [-1] for g in groups.values())


def test_exact_dedup(docs):
    groups = {}
    for id, text in ROWS:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), low(id), text or "", (id, text)))
    got = pairs(exact_dedup.dedup(docs), docs)
    # null and "" of one id would tie; here their ids differ
    assert got == Counter(min(g, key=lambda x: x[:3])[-1] for g in groups.values())
    fate = exact_dedup.decide(docs).collect()
    assert len(fate) == len(ROWS) and sum(r["kept"] for r in fate) == len(groups) and sum(got.values()) == len(groups)


def test_exact_dedup_of_a_hot_group(spark):
    """Repeated winners of a digest that most rows have."""
    rows = [(None, "same text")] * 500 + [(3, "same  text")] * 300 + [(2, "sametext")] * 300 + [(i, f"text {i}") for i in range(10, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    fate = exact_dedup.decide(df, k=4).collect()
    hot = [r for r in fate if r["group_size"] == 1100]
    assert len(fate) == len(rows) and len(hot) == 1100 and {r["keep_id"] for r in hot} == {3} and [r["id"] for r in hot if r["kept"]] == [3]
    assert Counter((r["doc_id"], r["text"]) for r in exact_dedup.dedup(df, k=4).collect()) == Counter({(3, "same  text"): 1} | {(i, f"text {i}"): 1 for i in range(10, 60)})


def test_simhash(docs):
    keys = dict(enumerate(ROWS))
    of = classes(prints({k: t for k, (_, t) in keys.items()}))
    groups = {}
    for k, (id, text) in keys.items():
        groups.setdefault(of[k], []).append((low(id), id, text))
    got = pairs(simhash.dedup(docs), docs)
    assert sum(got.values()) == len(groups)
    for g in groups.values():
        first = min(x[0] for x in g)
        assert sum(got[x] for x in {x[1:] for x in g if x[0] == first}) == 1


def test_substring_dedup(spark, docs):
    """Rows of equal id never take words from each other, and a null id is the largest."""
    first = {}
    for id, text in ROWS:
        w = words(text)
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), (True, 1)), low(id))
    want = Counter()
    for id, text in ROWS:
        w = words(text)
        gone = {k + d for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < low(id) for d in range(13)}
        if len(gone) < len(w) or not w:
            want[id, text is None, " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    got = Counter()
    for (id, text), n in pairs(substring_dedup.dedup(docs), docs).items():
        got[id, text is None, " ".join(words(text))] += n
    assert got == want
    with pytest.raises(TypeError):
        substring_dedup.dedup(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_quality_rules(docs):
    got = pairs(quality_rules.clean(docs), docs)
    want = Counter()
    for id, text in ROWS:
        if len(words(text)) >= 20 and "z" != (text or "")[:1]:
            w = words(text)
            n = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
            if 100 * len({k + d for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for d in range(8)}) <= 30 * len(w):
                want[id, text] += 1
    assert got == want and want


def test_quality_model(spark, docs):
    """Equal texts get equal scores, whatever their ids; labels of null and repeated ids don't break the fit."""
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, 0), (3, 1), (6, 0), (8, None)], "doc_id long, quality int")
    model = quality_model.train(docs, labels)
    rows = quality_model.score(docs.drop("score"), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    by = {}
    assert all(by.setdefault(r["text"] or "", r["score"]) == r["score"] for r in rows)
    got = pairs(quality_model.keep(docs, model, threshold=0.3), docs)
    assert got == Counter((id, text) for id, text in ROWS if by[text or ""] >= 0.3)


def test_shards(docs):
    got = sharding.interleave(docs.withColumn("source", F.when(F.col("doc_id") > 2, "s")), 3).collect()
    assert Counter((r["id"], r["size"]) for r in got) == Counter((id, len((text or "").encode()) + 1) for id, text in ROWS)
    by = [sorted(r["slot"] for r in got if r["shard"] == k) for k in range(3)]
    assert all(x == list(range(len(x))) for x in by) and max(map(len, by)) - min(map(len, by)) <= 1


@pytest.mark.parametrize("kind", ["long", "int", "string", "decimal(20,0)"])
def test_packing(docs, kind):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(docs.withColumn("doc_id", F.col("doc_id").cast(kind)), path, public_tokenizers.PATTERN, length=32).collect()
    encoder = bpe.Encoder(path, public_tokenizers.PATTERN)
    want, have = Counter(), Counter()
    for id, text in ROWS:
        want[str(id)] += len(encoder.encode(text or "")) // 4 + 1
    for r in got:
        have[str(r["id"])] += r["length"]
    assert have == want
    packing.pack(docs.where("doc_id IS NULL").withColumn("doc_id", F.col("doc_id").cast(kind)), path, public_tokenizers.PATTERN).collect()


def test_bpe(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(ROWS) and all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumn("IDS", F.lit(1)), path, public_tokenizers.PATTERN)


def test_chat(spark):
    rows = [(None, None, None, "user", "a"), (None, None, None, "user", "a"), (None, 1, None, None, None), (2, 1, None, "assistant", "b")]
    events = spark.createDataFrame(rows, "conv long, turn long, kind string, role string, text string").select("*", F.col("turn").alias("seq"), *[F.lit(c).alias(c) for c in ("n", "at", "back", "undone", "had", "opens", "p")])
    out = chat.render(chat.fold(events)).collect()
    one = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert {r["conv"]: r["formatted"] for r in out} == {None: one("user", "a") * 2 + one("", ""), 2: one("assistant", "b")}


def test_stages(spark, docs):
    """Each stage of the pipeline on such rows: it keeps the columns, and what the operator keeps."""
    stage = dict(corpus_pipeline.STAGES)
    assert pairs(stage["exact_dedup"](spark, docs, ""), docs) == pairs(exact_dedup.dedup(docs), docs)
    near = pairs(stage["simhash_dedup"](spark, docs, ""), docs)
    assert near[1, PROSE * 2] == 1 and not near[None, PROSE * 2] and near[None, "y"] == 1 and sum(n for (_, t), n in near.items() if not t) == 1
    assert pairs(stage["substring_dedup"](spark, docs, ""), docs) == pairs(substring_dedup.dedup(docs), docs)
    pieces = stage["packing"](spark, docs, "").collect()
    assert Counter(str(r["doc_id"]) for r in pieces) == Counter(str(id) for id, _ in ROWS)
    for name in ("exact_dedup", "simhash_dedup", "substring_dedup", "packing"):
        assert stage[name](spark, docs.where("false"), "").count() == 0
