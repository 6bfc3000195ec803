"""Byte-level BPE with the tokenizers library: encoding, offsets and decoding over Arrow batches.

The library's BPE model works on characters, one for each byte (``byte_chars``).  A text is cut into the matches of the
tokenizer's pattern; each distinct match is mapped to those characters and given to the model once, as long as it is in
a worker's bounded cache.  A rank file becomes a model whose merges are all splits of a token into two others, in the
order of ranks, and whose known pieces are taken whole, which is what the rank format means.

Defined results: a null text is the empty text, without tokens; any text decodes to its UTF-8 bytes; repeated rows get
equal results; null ids in a list of tokens are skipped; unknown ids raise ValueError; an empty table gives no rows;
columns of the input keep their names, and the names of new columns are parameters.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import small_batches, table

#: Distinct pieces that a worker remembers; at about 200 bytes each.
CACHE = 1_000_000
#: Longer pieces are not remembered.
LONG = 64

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Ends of sentences, and what may stand after them.
_ENDERS, _CLOSERS = {".", "!", "?", "…", "。", "！", "？"}, "\"')]’”»」』）"
#: The end of a sentence up to the lone space after it, or, after full-width signs, up to the next letter or number.
_STOP = re.compile("[.!?…。！？][\"')\\]’”»」』）]*(?: (?=\\S)|(?:(?<=[。！？])|(?<=[。！？][”」』）]))(?=[^\\W\\d_]))")
#: The same in UTF-8, up to white space other than a line end; and line ends.
_AFTER = "(?:[\"')\\]]|’|”|»|」|』|）)*"
_STOP_BYTES = re.compile(rf"[.!?\n\xe2\xe3\xef](?:(?<=\n)|(?<=[.!?]){_AFTER}(?=[ \t\r])|(?<=\xe2)\x80\xa6{_AFTER}(?=[ \t\r])|(?<=\xe3)\x80\x82{_AFTER}|(?<=\xef)\xbc[\x81\x9f]{_AFTER})".encode())
_NONE: set = set()


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if it is printable Latin-1 without white space, else the next from U+0100."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@lru_cache(maxsize=4)
def load(path: str):
    """(model, bytes of each id) of a tokenizer's file: JSON of the library, or ranks (base64 token and rank a line)."""
    from tokenizers import Tokenizer, models

    chars = byte_chars()
    if not path.endswith(".tiktoken"):
        tokenizer = Tokenizer.from_file(path)
        back = {c: b for b, c in enumerate(chars)}
        spell = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t, i in tokenizer.get_vocab().items()}
        return tokenizer.model, spell
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}
    shown = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [(shown[t[:k]], shown[t[k:]]) for t in sorted(ranks, key=ranks.get) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    model = models.BPE(vocab={shown[t]: i for t, i in ranks.items()}, merges=merges, ignore_merges=True)
    return model, {i: t for t, i in ranks.items()}


def special_tokens(path: str) -> dict[str, bytes]:
    """The strings of a tokenizer file's special tokens, and their ids as bytes; a file of ranks has none."""
    if path.endswith(".tiktoken"):
        return {}
    from tokenizers import Tokenizer

    return {t.content: i.to_bytes(4, "little") for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items() if t.special}


class Gap(Exception):
    """Two white spaces side by side, or one at an end of a text, where pieces between lone ones aren't enough."""


class Known(dict):
    """The ids of pieces, computed when first asked for.  When half full, it forgets those not asked for since it last was."""

    def __init__(self, compute: Callable[[str], bytes]):
        self.compute, self.old = compute, {}

    def __missing__(self, piece: str) -> bytes:
        got = self.old.get(piece)
        if got is None:
            if not piece or piece[0].isspace() or piece[-1].isspace():
                raise Gap
            got = self.compute(piece)
        if len(piece) <= LONG:
            if len(self) >= CACHE // 2:
                self.old = dict(self)
                self.clear()
            self[piece] = got
        return got


class Encoder:
    """Texts to token ids, as bytes of little-endian unsigned 32-bit numbers.

    No match of the pattern reaches over a lone space or line end, so the pieces between them are encoded one by one:
    those after a space with that space, those at the begin of a line without.

    ``control``: the strings of the file's special tokens inside a text become these tokens, as the library does unless its
    ``encode_special_tokens`` is set; without it they are text like any other.
    """

    def __init__(self, path: str, pattern: str, control: bool = False):
        self.model, self.spell = load(path)
        self.control = special_tokens(path) if control else {}
        self.find_control = regex.compile("(" + "|".join(map(regex.escape, sorted(self.control, key=len, reverse=True))) + ")") if self.control else None
        self.find = regex.compile(pattern).findall
        self.chars = "".join(byte_chars())
        self.pieces: dict[str, bytes] = {}  # of other matches
        self.after_space, self.at_begin = Known(self.spaced), Known(self.plain)
        self.line_end = self.plain("\n")

    def model_ids(self, piece: str) -> bytes:
        shown = piece.encode().decode("latin-1").translate(self.chars)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def match(self, piece: str) -> bytes:
        """The ids of one match of the pattern."""
        if piece[0] == " " and piece[1:].isalpha():
            return self.after_space[piece[1:]]
        got = self.pieces.get(piece)
        if got is None:
            got = self.model_ids(piece)
            if len(piece) <= LONG:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[piece] = got
        return got

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.match, self.find(text)))

    def spaced(self, piece: str) -> bytes:
        """The ids of a space and what follows up to the next lone space."""
        if piece.isalpha():
            return self.model_ids(" " + piece)  # one match of the pattern
        if (core := piece.rstrip(".,;:!?")).isalpha():
            return self.after_space[core] + self.match(piece[len(core) :])  # two matches
        return self.plain(" " + piece)

    def lines(self, text: str) -> tuple[list[str], bool]:
        """The lines of a text, and whether the last one ends."""
        lines = text.split("\n")
        ended = len(lines) > 1 and not lines[-1]
        return lines[: len(lines) - ended], ended

    def line(self, line: str) -> bytes:
        first, space, rest = line.partition(" ")
        return self.at_begin[first] + b"".join(map(self.after_space.__getitem__, rest.split(" "))) if space else self.at_begin[first]

    def encode(self, text: str) -> bytes:
        if self.find_control and self.find_control.search(text):
            return b"".join(self.control.get(x) or self.encode(x) for x in self.find_control.split(text))
        if not text:
            return b""
        lines, ended = self.lines(text)
        try:
            return self.line_end.join(map(self.line, lines)) + self.line_end * ended
        except Gap:
            return b"".join(self.around_gaps(text)[1])

    def around_gaps(self, text: str) -> tuple[list[str], list[bytes]]:
        """A text's pieces between lone spaces and the ids of each, where white space may stand side by side in a piece."""
        first, *rest = pieces = _LONE_SPACE.split(text)
        plain = lambda x: x and not x[0].isspace() and not x[-1].isspace()
        return pieces, [self.plain(first), *(self.after_space[x] if plain(x) else self.plain(" " + x) for x in rest)]

    def sentences(self, text: str) -> tuple[bytes, list[int]]:
        """The ids, and the numbers of ids before which a sentence or line has ended (ascending, without the last)."""
        if self.find_control and self.find_control.search(text):
            out, every, n = [], [], 0
            for x in self.find_control.split(text):
                got, ends = (self.control[x], []) if x in self.control else self.sentences(x)
                every += [n + k for k in ends]
                n += len(got) // 4
                out.append(got)
            return b"".join(out), every
        if not text:
            return b"", []
        lines, ended = self.lines(text)
        after, out, ends, n = self.after_space.__getitem__, [], [], 0
        try:
            for line in lines:
                at, spaced = 0, False
                for m in [*_STOP.finditer(line), None]:
                    stop = m.end() if m else len(line)
                    space = m is not None and line[stop - 1] == " "
                    unit = line[at : stop - space]
                    if spaced:
                        got = b"".join(map(after, unit.split(" ")))
                    else:
                        got = self.line(unit)
                    out.append(got)
                    n += len(got) // 4
                    ends.append(n)
                    at, spaced = stop, space
                out.append(self.line_end)
                n += len(self.line_end) // 4
                ends[-1] = n
        except Gap:
            return self.sentences_around_gaps(text)
        if not ended:
            out.pop()
        return b"".join(out), ends[:-1]

    def sentences_around_gaps(self, text: str) -> tuple[bytes, list[int]]:
        """The same; of a piece with line ends the last counts, and otherwise its end if a sentence ends there."""
        pieces, got = self.around_gaps(text)
        ends, n = [], 0
        for k, (piece, ids) in enumerate(zip(pieces, got)):
            if (at := piece.rfind("\n")) >= 0:
                ends.append(n + min(len(self.plain(" " * (k > 0) + piece[: at + 1])), len(ids)) // 4)
            elif piece.rstrip(_CLOSERS)[-1:] in _ENDERS:
                ends.append(n + len(ids) // 4)
            n += len(ids) // 4
        return b"".join(got), [x for x in ends if 0 < x < n]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of tokens, one after another; a character's bytes may come from several tokens."""
        try:
            return b"".join(map(self.spell.__getitem__, ids.tolist()))
        except KeyError as e:
            raise ValueError(f"no token has the id {e}") from e

    def offsets(self, ids: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each token the first character it has bytes of, and the one after the last."""
        ends = np.cumsum(np.fromiter((len(self.spell[i]) for i in ids.tolist()), np.int64, len(ids)))
        begins = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # characters begun, up to each byte
        starts = np.r_[0, ends[:-1]] if len(ids) else ends
        return begins[starts] - 1, begins[ends - 1]


class RankEncoder:
    """The ids of ``Encoder`` and the ends of sentences, by ranks: in half the time, and without remembering pieces.

    It is for files whose merges stand in the order of their results' ids (``by_ranks`` says whether a file is one): the ids
    are ranks then.  A text that the rank library's pattern engine gives up (runs of white space of about a million
    characters) goes to an ``Encoder``.
    """

    def __init__(self, path: str, pattern: str, control: bool = False):
        import tiktoken

        self.slow, spell = per_worker(path, pattern, control), load(path)[1]
        special = {int.from_bytes(x, "little") for x in special_tokens(path).values()}
        ranks = {t: i for i, t in spell.items() if i not in special}
        self.encode_to_buffer = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_to_tiktoken_buffer
        self.size = np.zeros(max(spell) + 1, np.int64)
        self.size[list(spell)] = [len(t) for t in spell.values()]

    def sentences(self, text: str, raw: bytes) -> tuple[bytes, list[int]]:
        """Of a text and its UTF-8: the ids, and the numbers of ids before which a sentence or line has ended (without the last)."""
        if self.slow.find_control and self.slow.find_control.search(text):
            return self.slow.sentences(text)
        try:
            ids = np.frombuffer(self.encode_to_buffer(text, _NONE), np.uint32)
        except ValueError:
            return self.slow.sentences(text)
        stops = [m.end() for m in _STOP_BYTES.finditer(raw)]
        if not stops:
            return ids.tobytes(), []
        ends = np.cumsum(self.size[ids])
        at = np.searchsorted(ends, stops)
        # only where a token ends, too
        at = at[(ends[at] == stops) & (at < len(ids) - 1)] + 1
        return ids.tobytes(), at.tolist()


def by_ranks(path: str) -> bool:
    """Whether a tokenizer file's merges are in the order of the ids that they make, which are ranks then."""
    if path.endswith(".tiktoken"):
        return True
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return False
    made = [model["vocab"]["".join(x.split(" ") if isinstance(x, str) else x)] for x in model["merges"]]
    return all(a < b for a, b in zip(made, made[1:])) and len(set(model["vocab"].values()) - set(made)) == 256 and all(c in model["vocab"] for c in byte_chars())


def _lists(parts: list[bytes]) -> pa.ListArray:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


@lru_cache(maxsize=2)
def per_worker(path: str, pattern: str, control: bool = False) -> Encoder:
    return Encoder(path, pattern, control)


@lru_cache(maxsize=2)
def marker(path: str, pattern: str, control: bool = False) -> Callable[[str, bytes], tuple[bytes, list[int]]]:
    """What gives a text (and its UTF-8) ids and ends of sentences."""
    if by_ranks(path):
        return RankEncoder(path, pattern, control).sentences
    encoder = per_worker(path, pattern, control)
    return lambda text, raw: encoder.sentences(text)


def add_columns(df: DataFrame, source: str, added: list[StructField], compute: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``df`` with columns computed from one of its columns, batch by batch."""
    small_batches(df.sparkSession)
    at = df.columns.index(source)
    taken = {c.lower() for c in df.columns}
    if clash := [x.name for x in added if x.name.lower() in taken]:
        raise ValueError(f"the input has columns of these names already: {clash}")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *compute(b.column(at))], names=[*b.schema.names, *(x.name for x in added)])

    return df.mapInArrow(over, StructType([*df.schema.fields, *added]))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", digest: str | None = None, starts: str | None = None, ends: str | None = None) -> DataFrame:
    """``df`` with token ids (array<int>); on request the SHA-256 of the ids (little-endian, 32 bits), and character offsets.

    A name that ``df`` has already (whatever its case) raises ValueError.
    """
    added = [StructField(ids, ArrayType(IntegerType(), False))]
    added += [StructField(digest, StringType())] if digest else []
    added += [StructField(x, ArrayType(IntegerType(), False)) for x in (starts, ends) if x]

    def compute(column: pa.Array) -> list[pa.Array]:
        encoder = per_worker(path, pattern)
        texts = [x or "" for x in column.to_pylist()]
        got = [encoder.encode(x) for x in texts]
        out: list[pa.Array] = [_lists(got)]
        if digest:
            out.append(pa.array([hashlib.sha256(x).hexdigest() for x in got]))
        if starts or ends:
            both = [encoder.offsets(np.frombuffer(x, "<u4"), t.encode()) for x, t in zip(got, texts)]
            out += [_lists([x[k].astype("<i4").tobytes() for x in both]) for k, wanted in enumerate((starts, ends)) if wanted]
        return out

    return add_columns(df, text, added, compute)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", raw: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its token ids spell (binary; cast it to string for text)."""

    def compute(column: pa.Array) -> list[pa.Array]:
        encoder = per_worker(path, pattern)
        return [pa.array([encoder.decode(pa.array(x.values).drop_null().to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in column], pa.binary())]

    return add_columns(df, ids, [StructField(raw, BinaryType())], compute)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    rows = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern, digest="ids_sha256").drop("text")
    rows = decode(rows, path, pattern)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
