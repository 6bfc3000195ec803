"""Personal data in texts: candidate spans, boosted trees that judge them, and calibrated thresholds that select redactions.

Spans that match a strict rule of their kind (``base``) always stay.  Besides, generators of high recall propose candidate spans,
which overlap each other: e-mail addresses written with words or brackets for their signs, numbers that may be
telephone or card numbers in any grouping, dotted numbers with brackets or blanks.  Boosted trees score a candidate by its
format (digits, groups, separators, check digits) and its context (the characters and words around it); the spans whose score reaches the threshold of
their kind are added, the likeliest first, unless they overlap one that is there.

No table says which spans are personal data, so the trees learn from the texts themselves: a strict span is an example of
label 1, and so are its rewritings in other formats, in its own context; numbers that can't be what they look like (a wrong
check digit, a part over 255, letters at their side, a version or an item number) are examples of label 0, and so are strict spans that are
spoilt in such ways.  All other candidates are left out of the fit.  Examples come from about ``DOCUMENTS`` documents, drawn by hashes, and at most ``SAMPLE``
of each kind and label, of the smallest hashes, are used; equal windows of text count once, so that copies change nothing.
A fifth of the examples, kept out of the fit, calibrates the thresholds.  A kind without examples of both labels gets no spans besides
strict ones.

Scoring reads every whole text, shuffles nothing, and needs time in proportion to a text's length.

Defined results: a null, empty or blank text has no spans; repeated rows get equal results; an empty table gives no rows; other columns
pass through ``with_spans`` and ``redact`` whatever their names.  Places count code points.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm import boosting
from tidemark.llm.common import small_batches, table

#: Kinds in order.  Fixed values.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Documents that examples are drawn from, about, and examples of a kind and label at most.
DOCUMENTS, SAMPLE = 12_000, 1500
#: Characters around a span that are its context, and the calibrated share of right spans that is asked of an added one.
AROUND, PRECISION = 60, 0.95

Span = tuple[int, int, int]  # start, end, kind

# The strict rules.  Starts in the middle of a run of digits are left out where the run's start would match as well, so that time is linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_QUAD = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# The generators: signs of addresses, and areas of digits and separators, in which patterns of numbers are searched.  _BLOCKS and
# _LOCAL_CALL take parts of what _LONG and _CALL take, as numbers may stand next to each other.
_AT = re.compile(r"@| at | AT |[\[({<] ?[Aa][Tt] ?[\])}>] ?")
_HOST = re.compile(r"(?i)[a-z0-9-]{1,63}(?:(?: ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| dot |\.)[a-z0-9-]{1,63}){0,6}")
_AREA = re.compile(r"[0-9][][0-9 ().\/_+-]{4,}")
_PARTS = re.compile(r"(?<![0-9.])[0-9]{1,5}(?: ?[\[(]?\.[\])]? ?[0-9]{1,5}){2,6}")
_LONG = re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){11,22}")
_CALL = re.compile(r"(?:\+|\b00|\(|(?<![0-9]))\(?[0-9]{1,5}\)?(?:[ ./-]{0,2}\(?[0-9]{1,5}\)?){1,7}")
_BLOCKS = re.compile(r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([ ._/-]{1,3})[0-9]{4}\1[0-9]{4}\1[0-9]{2,7})(?![0-9])")
_LOCAL_CALL = re.compile(r"(?:(?:\+|\b00)[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|(?<![0-9])[0-9]{3}[ ./-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])")
_CONTACT = re.compile(r"(?i)\b(?:tel|fax|call|phone|mobile|cell|contact|telefon|handy|t[ée]l[ée]phone|tel[ée]fono|m[óo]vil|e-?mail|mail|write|reach|ip|host|server|address|card|visa|credit|karte|carte|tarjeta)\b")
_NUMBER = re.compile(r"(?i)\b(?:version|v|no|nr|number|id|isbn|issn|order|page|token|key|password|hash|build|section|license|chapter|price|total|row|item|code)\b")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _before_at(text: str, at: int, low: int) -> int:
    """Where the run of address characters in front of a place begins, not before ``low``."""
    while at > low and text[at - 1] in _LOCAL:
        at -= 1
    return at


def base(text: str) -> list[Span]:
    """The spans of the strict rules, by start and kind: of each kind the leftmost matches that don't overlap, without those that fail."""
    out: list[Span] = []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            start = _before_at(text, m.start(), last)
            if start < m.start():
                out.append((start, m.end(), EMAIL))
                last = m.end()
    out += [(m.start(), m.end(), IP) for m in _QUAD.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) < 256 for x in m[0].split("."))]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() > 13 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), CARD))
    if "+" in text:
        out += [(m.start(), m.end(), PHONE) for m in _PLUS.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data; they overlap."""
    out: set[Span] = set()
    for m in _AT.finditer(text):
        stop = m.start() - (m.start() > 0 and text[m.start() - 1] == " ")
        host, start = _HOST.match(text, m.end()), _before_at(text, stop, max(stop - 64, 0))
        if host and start < stop:
            out.add((start, host.end(), EMAIL))
    for area in _AREA.finditer(text):
        begin, stop = max(area.start() - 3, 0), area.end()  # a sign or bracket may stand in front
        for kind, patterns, low, high in ((IP, (_PARTS,), 3, 35), (CARD, (_LONG, _BLOCKS), 12, 23), (PHONE, (_CALL, _LOCAL_CALL), 7, 15)):
            for m in chain.from_iterable(p.finditer(text, begin, stop) for p in patterns):
                if low <= sum("0" <= c <= "9" for c in m[0]) <= high:
                    out.add((m.start(), m.end(), kind))
    return sorted(out)


def _side(c: str) -> float:
    return 0.0 if not c or c.isspace() else 1.0 if c.isalpha() else 2.0 if c.isdigit() else 3.0 if c in "\"'`" else 4.0 if c in "=:#/\\_" else 5.0


FEATURES = 31


def features(text: str, span: Span) -> list[float]:
    """Of a span's format and context, by what is AROUND it at most."""
    start, end, kind = span
    s, before, after = text[start:end], text[max(start - AROUND, 0) : start], text[end : end + AROUND]
    digits, groups = digits_of(s), re.findall("[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    tail = re.split(r"[.\s\])}>]+", s)[-1]
    near = (_CONTACT.search(before[-40:]), _NUMBER.search(before[-25:]), _CONTACT.search(after[:25]))
    return [
        *[float(kind == k) for k in range(4)], len(s), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], s.count(" "), s.count("."), s.count("-"),
        s.count("/"), sum(s.count(c) for c in "[]{}<>"), s.count("("), float(s[0] == "+"), float(s[:2] == "00"), float(len(digits) >= 12 and luhn(digits)), max([min(int(g[:6]), 999) for g in groups] or [0]), len(set(digits)),
        float("@" in s), sum(c.isalpha() for c in s), float(tail.isalpha() and 2 <= len(tail) <= 6) * len(tail), _side(before[-1:]), _side(after[:1]), float(near[0] is not None), float(near[1] is not None), float(near[2] is not None),
        float(bool(re.search(r"[0-9][ ,;./-]{0,2}$", before)) or bool(re.match(r"[ ,;./-]{0,2}[0-9]", after))),
    ]


# Examples

_CONTEXTS = ("call ", "tel. ", "phone: ", "contact ", "card ", "server ", "mail: ")
_ITEMS = ("version ", "no. ", "id ", "order ", "isbn ", 'token = "', "key=", "build ", "page ", "total ", "code ")


def rewritten(kind: int, s: str, draw: random.Random) -> list[tuple[str, str, int]]:
    """(context put in front, span, label): a strict span in other formats, and spoilt."""
    digits, ahead = digits_of(s), draw.choice(("", "", *_CONTEXTS))
    other = lambda d: str((int(d) + draw.randint(1, 9)) % 10)
    if kind == EMAIL:
        local, host = s.split("@")
        local = draw.choice((local, local.rstrip("0123456789").rstrip(".") or local, local.replace(".", "")))
        host = draw.choice((host, host.rsplit(".", 2)[-2] + "." + draw.choice(("com", "org", "net", "de", "fr", "es", "io"))))
        at, dot = draw.choice((" at ", " [at] ", "(at)", " AT ", " (at) ")), draw.choice((" dot ", "[dot]", ".", " DOT ", "(.)"))
        return [(ahead, local + at + host.replace(".", dot), 1), ("", re.sub("[^a-z]", "", local) + " at " + re.sub("[^a-z]", "", host), 0), ("", f"{local}@{draw.randint(1, 99)}", 0), ("", "look at " + draw.choice(("this.It", "home.then", "once")), 0)]
    if kind == IP:
        parts = s.split(".")
        wrong = [*parts]
        wrong[draw.randrange(4)] = str(draw.randint(256, 999))
        return [(ahead, draw.choice(("[.]", " . ", "(.)")).join(parts), 1), ("", ".".join(wrong), 0), (draw.choice(_ITEMS), ".".join(parts[:3]), 0), ("", ".".join([*parts, parts[0]]), 0)]
    if kind == CARD:
        sign = draw.choice((".", "  ", " - ", "/", "_"))
        wrong = digits[:5] + other(digits[5]) + digits[6:]
        return [(ahead, sign.join(digits[k : k + 4] for k in range(0, len(digits), 4)), 1), ("", wrong, 0), (draw.choice(_ITEMS), sign.join(wrong[k : k + 4] for k in range(0, len(wrong), 4)), 0), ("", f"{wrong}{other('1')}abc", 0)]
    a, b, c, country = digits[-10:-7], digits[-7:-4], digits[-4:], digits[:-10] or "1"
    good = draw.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00{country} {a} {b} {c}", f"{country}-{a}-{b}-{c}", f"{a}/{b}{c}"))
    day = f"{draw.randint(1990, 2030)}-{draw.randint(10, 12)}-{draw.randint(10, 28)}"
    return [(ahead, good, 1), (draw.choice(_ITEMS), a + b + c, 0), ("", f"{day} {draw.randint(10, 23)}", 0), (draw.choice(_ITEMS), f"{a}-{b}-{c}", 0), ("", f"{draw.randint(1, 9)}.{a}.{b}", 0), ("", f"978-{a[0]}-{b[:2]}-{c}{a[1:]}-{c[0]}", 0)]


def _impossible(text: str, span: Span) -> bool:
    """Whether a candidate that no strict rule takes can't be of its kind."""
    start, end, kind = span
    s = text[start:end]
    sides = text[start - 1 : start].isalpha() or text[end : end + 1].isalpha()
    if kind == CARD:
        return sides or not luhn(digits_of(s))
    if kind == IP:
        return sides or any(int(g) > 255 for g in re.findall("[0-9]+", s)) or _NUMBER.search(text[max(start - 25, 0) : start]) is not None
    return kind == PHONE and sides


def _overlap(a: Span, b: Span) -> bool:
    return a[0] < b[1] and b[0] < a[1]


def examples(text: str) -> Iterator[tuple[int, int, int, list[float]]]:
    """(hash of the window, kind, label, features) of all examples of a text."""

    def one(window: str, span: Span, label: int) -> tuple[int, int, int, list[float]]:
        name = f"{span[0]}:{span[1]}:{span[2]}:{label}:{window}".encode("utf-8", "surrogatepass")
        return xxhash.xxh64_intdigest(name, 12) >> 1, span[2], label, features(window, span)

    strict, found = base(text), candidates(text)
    whole = {s for s in strict}
    for s in found:
        low = max(s[0] - AROUND, 0)
        window, moved = text[low : s[1] + AROUND], (s[0] - low, s[1] - low, s[2])
        if s in whole:
            yield one(window, moved, 1)
        elif s[1] - s[0] <= AROUND and not any(_overlap(s, x) for x in strict) and _impossible(text, s):
            yield one(window, moved, 0)
    for start, end, kind in strict:
        before, after = text[max(start - AROUND, 0) : start], text[end : end + AROUND]
        draw = random.Random(zlib.crc32(text[start:end].encode()))
        for ahead, new, label in rewritten(kind, text[start:end], draw) + rewritten(kind, text[start:end], draw):
            low = len(before) + len(ahead)
            window, own = before + ahead + new + after, (low, low + len(new), kind)
            for s in candidates(window):
                if _overlap(s, own) and (s[2] != kind or label == 0 or s[:2] == own[:2]):
                    yield one(window, s, label if s[2] == kind else 0)


@dataclass(frozen=True)
class Model:
    """The trees (None without examples) and the margin from which a candidate of each kind is taken."""

    trees: boosting.Trees | None
    thresholds: tuple[float, ...]


def sample(df: DataFrame, id: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, size: int = SAMPLE) -> DataFrame:
    """Rows (h, kind, label, x) of examples, at most ``size`` of each kind and label, from about ``documents`` documents."""
    small_batches(df.sparkSession)
    part = min(documents / max(df.count(), 1), 1.0)
    drawn = F.shiftrightunsigned(F.xxhash64(F.col(id), F.col(text), F.lit(12)), 11) < int(part * (1 << 53))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], dict[int, list[float]]] = {}
        for b in batches:
            for t in b.column(0).to_pylist():
                for h, kind, label, x in examples(t or ""):
                    own = held.setdefault((kind, label), {})
                    own[h] = x
                    if len(own) > 2 * size:  # only the smallest count
                        held[kind, label] = {k: own[k] for k in sorted(own)[:size]}
        rows = [(h, kind, label, own[h]) for (kind, label), own in held.items() for h in sorted(own)[:size]]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*rows)) or [()] * 4, kinds)], names=["h", "kind", "label", "x"])

    rows = df.where(drawn).select(text).mapInArrow(over, "h long, kind int, label int, x array<float>")
    rows = rows.groupBy("kind", "label", "h").agg(F.first("x").alias("x"))
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("kind", "label").orderBy("h"))).where(F.col("n") <= size).select("h", "kind", "label", "x")


def train(df: DataFrame, id: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, size: int = SAMPLE, precision: float = PRECISION) -> Model:
    """A model of the examples among ``df``: at most ``size`` of each kind and label go to the driver, where trees are fitted."""
    rows = sorted(map(tuple, sample(df, id, text, documents, size).collect()))
    return fitted(rows, precision)


def fitted(rows: list[tuple[int, int, int, list[float]]], precision: float = PRECISION) -> Model:
    """A model of sorted examples; every fifth by hash is kept out of the fit and calibrates."""
    x, kind, y = np.array([r[3] for r in rows], np.float32).reshape(-1, FEATURES), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
    held = np.array([r[0] // 7 % 5 == 0 for r in rows], bool)
    if len(set(y[~held].tolist())) < 2:
        return Model(None, (float("inf"),) * 4)
    trees = boosting.fit(x[~held], y[~held])
    score = trees.margins(x[held])
    of = [boosting.threshold(score[kind[held] == k], y[held][kind[held] == k], precision) for k in range(4)]
    both = [len(set(y[~held][kind[~held] == k].tolist())) == 2 for k in range(4)]
    return Model(trees, tuple(t if b else float("inf") for t, b in zip(of, both)))


# Spans


def spans_of(texts: list[str | None], model: Model | None) -> list[tuple[list[Span], list[Span]]]:
    """(strict spans, all spans) of each text, by start and kind."""
    out, rows, owner = [], [], []
    for i, t in enumerate(texts):
        t = t or ""
        strict = base(t)
        out.append((strict, list(strict)))
        if model and model.trees:
            # strict spans and candidates are both few in a text and sorted, so they are compared by their order
            for s in clear(candidates(t), strict):
                rows.append(s)
                owner.append(i)
    if rows:
        x = np.array([features(texts[i], s) for i, s in zip(owner, rows)], np.float32)
        margin = model.trees.margins(x)
        for i, added in _chosen(owner, rows, margin, model).items():
            out[i] = (out[i][0], sorted(out[i][1] + added, key=lambda s: (s[0], s[2])))
    return out


def clear(found: list[Span], held: list[Span]) -> list[Span]:
    """The spans of ``found`` that overlap none of ``held``; both by start."""
    if not held:
        return found
    start = np.array([s[0] for s in held])
    reach = np.maximum.accumulate([s[1] for s in held])
    k = np.searchsorted(start, [s[1] for s in found])  # those that begin before a span's end
    return [s for s, n in zip(found, k.tolist()) if not n or reach[n - 1] <= s[0]]


def _chosen(owner: list[int], rows: list[Span], margin: np.ndarray, model: Model) -> dict[int, list[Span]]:
    """Of each text the candidates over their kind's threshold, the largest lead first, without overlaps."""
    lead: dict[int, list[tuple[float, Span]]] = {}
    for i, s, m in zip(owner, rows, margin.tolist()):
        if m >= model.thresholds[s[2]]:
            lead.setdefault(i, []).append((model.thresholds[s[2]] - m, s))
    out = {}
    for i, some in lead.items():
        taken: set[int] = set()  # the code points of spans, which are short
        own = []
        for _, s in sorted(some):
            if taken.isdisjoint(range(s[0], s[1])):
                taken.update(range(s[0], s[1]))
                own.append(s)
        out[i] = own
    return out


def told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


SPANS = "array<struct<kind:string,start:long,end:long>>"


def with_spans(df: DataFrame, model: Model | None, text: str = "text", name: str = "spans") -> DataFrame:
    """``df`` with the spans of personal data (kind, start, end) of each text as ``name``; without a model the strict ones."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)
    kind = pa.list_(pa.struct([pa.field("kind", pa.string()), pa.field("start", pa.int64()), pa.field("end", pa.int64())]))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": z} for a, z, k in every] for _, every in spans_of(b.column(at).to_pylist(), model)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], names=[*b.schema.names, name])

    return df.mapInArrow(over, StructType([*df.schema.fields, StructField(name, StructType.fromDDL(f"x {SPANS}")["x"].dataType)]))


def redacted(text: str, spans: list[Span], mark: Callable[[str], str] = lambda kind: f"[{kind.upper()}]") -> str:
    """A text with a mark in the place of each stretch that spans cover; where they overlap, of the first of them."""
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], mark(KINDS[k])]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with [EMAIL], [IP], [CARD] or [PHONE] in the place of personal data; texts without any, and null ones, stay as they are."""
    small_batches(df.sparkSession)
    rows = df.select(F.struct("*").alias("row"), F.col(text).alias("text"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(1).to_pylist()
            new = [redacted(t, every) if every else t for t, (_, every) in zip(raw, spans_of(raw, model))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], names=["row", "text"])

    out = rows.mapInArrow(over, StructType([rows.schema["row"], StructField("text", StringType())]))
    return out.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns])


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(df)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for strict, every in spans_of(b.column(1).to_pylist(), model):
                n = [0] * 4
                for s in strict:
                    n[s[2]] += 1
                rows.append((*n, hashlib.sha256(told(strict).encode()).hexdigest(), told(every)))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in columns[:4]), *(pa.array(x, pa.string()) for x in columns[4:])], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return df.mapInArrow(over, ", ".join([f"doc_id {df.schema['doc_id'].dataType.simpleString()}", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"]))
