"""Archives read at many split sizes, and with corrupted, foreign and embedded members."""

import gzip
import hashlib
import io
import random
import struct
import zlib

import pytest

from tidemark.llm import warc

DATE = "1970-01-01T00:00:00Z"


def raw(page, payload, url=b"http://a/b"):
    return warc.record(page, url, payload, hashlib.sha1(payload).digest(), None, DATE)


def press(content, level=6):
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(content) + c.flush()


def with_extra(content, n):
    """A gzip member whose own header has a field of n bytes."""
    body = zlib.compressobj(6, zlib.DEFLATED, -15)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 6 + struct.pack("<H", n) + b"\x07" * n
    return head + body.compress(content) + body.flush() + struct.pack("<II", zlib.crc32(content), len(content))


def found(data, split, file=None):
    out = []
    for start in range(0, len(data), split):
        out += [(place, warc.parse(c)["page_id"], problem or warc.parse(c)["problem"]) for place, c, problem in warc.members(io.BytesIO(data), start, min(start + split, len(data)))]
    return sorted(out)


@pytest.mark.parametrize("split", [100, 1_000, 7_777, 50_000, 10**7])
def test_each_record_once_at_any_split(split):
    drawn = random.Random(2)
    parts = [press(raw(i, drawn.randbytes(drawn.randrange(3000)))) for i in range(200)]
    parts[7] = with_extra(raw(7, b"long gzip header"), 6000)
    parts[8] = with_extra(raw(8, b"longest gzip header"), 65_535)
    places = [sum(map(len, parts[:i])) for i in range(len(parts))]
    assert found(b"".join(parts), split) == [(p, i, None) for i, p in enumerate(places)]


def test_broken_and_foreign_bytes_are_told():
    whole = [press(raw(i, b"payload %d" % i * 50)) for i in range(6)]
    cut = whole[2][: len(whole[2]) // 2]
    no_length = press(raw(4, b"x").replace(b"Content-Length", b"Other-Length"))
    short = press(raw(5, b"some payload" * 9)[:-40])
    foreign = gzip.compress(b"no archive at all")
    data = whole[0] + b"junk \x1f\x8b\x08 junk" + whole[1] + cut + foreign + whole[3] + no_length + short
    got = {page: problem for _, page, problem in found(data, 10**6)}
    # of the broken member what can be inflated is read, and it says so
    assert got.pop(2, "broken member") == "broken member" and got.pop(None, "broken member") == "broken member"
    assert got == {0: None, 1: None, 3: None, 4: "no length", 5: "cut off"}


def test_a_member_inside_a_stored_payload_is_doubtful():
    inner = press(raw(9999, b"not a record of this archive"))
    outer = press(raw(1, b"a" * 2000 + inner + b"b" * 2000), level=0)
    data = press(raw(0, b"before")) + outer + press(raw(2, b"after"))
    for split in (500, 1500, 2100):
        assert [(page, problem) for _, page, problem in found(data, split) if page != 9999] == [(0, None), (1, None), (2, None)]
        assert all(problem == "found inside other bytes" for _, page, problem in found(data, split) if page == 9999)


def test_huge_member():
    payload = random.Random(1).randbytes(20 << 20)
    data = press(raw(1, payload), level=1) + press(raw(2, b"next"))
    assert [(page, problem) for _, page, problem in found(data, 1 << 20)] == [(1, None), (2, None)]


def test_round_trip(spark, tmp_path):
    """Null and repeated ids and payloads, and columns named like those of the archive, at splits smaller than a record."""
    rows = [(1, "http://a", "x" * 5000), (2, None, "x" * 5000), (2, None, "x" * 5000), (None, "u", "x" * 5000), (None, "u", "y"), (3, "v", None), (3, "v", None), (4, "w", "")]
    pages = spark.createDataFrame([(*r, "c", "c", 0) for r in rows], "page_id long, url string, html string, digest string, page string, first int")
    got = warc.read(warc.write(pages, str(tmp_path / "archive")), 64).collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0, r["payload_bytes"], r["url"] or "", r["problem"] or "") for r in got) == sorted(
        [(1, "response", 0, 5000, "http://a", ""), (2, "revisit", 1, 5000, "", ""), (2, "revisit", 1, 5000, "", ""), (0, "revisit", 1, 5000, "u", ""), (0, "response", 0, 1, "u", "")]
        + [(3, "response", 0, 0, "v", "")] * 2 + [(4, "revisit", 3, 0, "w", "")]
    )
    assert all(r["intact"] for r in got)
    assert warc.read(warc.write(pages.limit(0), str(tmp_path / "none"))).count() == 0
