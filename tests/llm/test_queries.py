"""Each operator's query against brute force: on the small tables, on awkward rows, and on empty tables."""

import base64
import hashlib
import re
import shutil
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

import corpus_pipeline
from test_near_dedup import firsts, linked
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from a very old oak tree nearby. "
SCHEMA = {"documents": "doc_id text lang source n_chars", "labels": "doc_id quality toxic", "pages": "page_id url html", "conversations": "conv_id turn role text"}


def awkward() -> dict[str, list[dict]]:
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    texts = [None, "", " \t\n", "a", "a  b", "ab", "a b", PROSE, PROSE, PROSE.replace("owls", "cats"), PROSE + "Extra words follow here.", long, long, "x " * 500, "é ß 漢字 🙂 \x00 <|endoftext|>", PROSE * 8, "menu\nhome\nmenu\n" * 9]
    docs = [{"doc_id": i, "text": t, "lang": None if i % 3 else "en", "source": None if i % 4 == 1 else "hot", "n_chars": None if t is None else len(t)} for i, t in enumerate(texts)]
    pages = [{"page_id": i, "url": None if i == 2 else f"http://a/{i}\r\nX: y", "html": t} for i, t in enumerate([None, "", "<p>a</p>", "<p>a</p>", "\r\n\r\nWARC/1.0\r\n", "é", "\x1f\x8b\x08 gzip?", "<p>a</p>"])]
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, "user", "<|im_end|><|im_start|>"), (2, 1, "assistant", "&lt;\\<|&"), (2, 2, None, ""), (3, 0, "assistant", "a"), (3, 1, "assistant", "b")]
    return {
        "documents": docs, "labels": [{"doc_id": i, "quality": i % 2, "toxic": 0} for i in (3, 4, 5, 7, 9, 11)], "pages": pages,
        "conversations": [dict(zip(("conv_id", "turn", "role", "text"), t)) for t in turns],
    }


@pytest.fixture(scope="module", params=["small", "awkward", "empty"])
def sf(request, tmp_path_factory):
    if request.param == "small":
        yield SF
        return
    at = tmp_path_factory.mktemp(request.param)
    rows = awkward()
    for name, columns in SCHEMA.items():
        schema = pq.read_schema(f"{SF}/{name}.parquet")
        pq.write_table(pa.Table.from_pylist(rows[name] if request.param == "awkward" else [], schema=pa.schema([schema.field(c) for c in columns.split()])), at / f"{name}.parquet")
    yield str(at)
    shutil.rmtree(at)


def documents(sf) -> dict[int, str]:
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}


def run(spark, name, sf):
    return [r.asDict() for r in QUERIES[name](spark, sf).collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_warc(spark, sf):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in pq.read_table(f"{sf}/pages.parquet").to_pylist()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = {r["page_id"]: tuple(r[c] for c in ("payload_bytes", "payload_digest", "record_type", "refers_to")) for r in run(spark, "op1_warc", sf)}
    want = {i: (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first[p] == i else "revisit", None if first[p] == i else first[p]) for i, p in pages.items()}
    assert got == want


def test_shards(spark, sf):
    docs, got = documents(sf), run(spark, "op2_shards", sf)
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(8))
    counts = [len(by[k]) for k in range(8)]
    assert {r["law"] for r in got} <= {"rows"} and max(counts) - min(counts) <= 1


def check_pieces(got, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    by, fill = defaultdict(list), defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by) == set(docs)
    for i, text in docs.items():
        ids, at = [*t.encode(text or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0 and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids)
    for s in fill.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048


def test_packing(spark, sf):
    check_pieces(run(spark, "op3_packing", sf), documents(sf))


def exact_groups(docs):
    groups = defaultdict(list)
    for i, t in docs.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append(i)
    return {i: (k, min(g, key=lambda j: (-len(docs[j] or ""), j)), len(g)) for k, g in groups.items() for i in g}


def test_exact_dedup(spark, sf):
    want = {i: (keep, n, keep == i, sha(k)) for i, (k, keep, n) in exact_groups(documents(sf)).items()}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in run(spark, "op4_exact_dedup", sf)} == want


def test_quality_model(spark, sf):
    got = {r["doc_id"]: r for r in run(spark, "op5_quality_model", sf)}
    assert set(got) == set(documents(sf))
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_quality_model_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    got = [(r["score"], labels[r["doc_id"]]) for r in run(spark, "op5_quality_model", sf) if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, q in got if q == 1], [s for s, q in got if q == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    assert auc >= 0.9, auc
    assert sum(s >= 0.3 for s in good) / len(good) >= 0.95


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in SCHEMA:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[c] for c in names) for r in run(spark, name, sf)) == sorted(want.fetchall())


def test_quality_rules(spark, sf):
    docs = documents(sf)
    got = {r["doc_id"]: r for r in run(spark, "op7_quality_rules", sf)}
    assert set(got) == set(docs)
    for i, text in docs.items():
        w, seen, dup = words(text), set(), 0
        for line in (text or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        n = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        inside = {k + d for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for d in range(8)}
        failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed)
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
        assert not (failed and got[i]["kept"])


def prints(docs):
    out = {}
    for i, text in docs.items():
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        out[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return out


def classes(fp):
    low = {i: i for i in fp}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(fp)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {i: root(i) for i in ids}


def test_simhash(spark, sf):
    fp = prints(documents(sf))
    of = classes(fp)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op8_simhash", sf)} == {i: (f"{fp[i]:016x}", of[i]) for i in fp}


def left_words(docs):
    first = {}
    lists = {i: words(docs[i]) for i in sorted(docs)}
    for i, w in lists.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    out = {}
    for i, w in lists.items():
        gone = {k + d for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for d in range(13)}
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_substring_dedup(spark, sf):
    docs = documents(sf)
    left = left_words(docs)
    want = {i: (len(words(docs[i])), len(words(docs[i])) - len(w), sha(" ".join(w))) for i, w in left.items()}
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in run(spark, "op9_substring_dedup", sf)} == want


def test_byte_bpe(spark, sf):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, text in documents(sf).items():
        ids = enc.encode_ordinary(text or "")
        want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), sha(text or ""))
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in run(spark, "op10_byte_bpe", sf)} == want


def test_pipeline(spark, sf):
    """The quality stage's documents, then brute force for each stage on what its predecessor keeps."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    if not docs.count():
        assert corpus_pipeline.run(spark, sf).count() == 0
        return
    stage = dict(corpus_pipeline.STAGES)
    first = stage["quality_model"](spark, docs, sf)
    assert first.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in first.collect()}
    assert text.items() <= documents(sf).items()
    text = {i: text[i] for i, (_, keep, _) in exact_groups(text).items() if keep == i}
    text = {i: text[i] for i in firsts(text, linked(text))}
    left = {i: w for i, w in left_words(text).items() if w or not words(text[i])}
    frame = docs.where(docs.doc_id.isin(list(text)) if text else "false")
    cut = stage["substring_dedup"](spark, frame, sf)
    assert cut.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert {i: words(t) for i, t in kept.items()} == left
    check_pieces([r.asDict() for r in corpus_pipeline.run(spark, sf).collect()], kept)
