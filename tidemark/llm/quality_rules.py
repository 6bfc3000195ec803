"""Line-first cleaning of documents.

Every line with a word is judged alone: punctuation (it never ends a sentence, or is full of symbols), navigation (many
separators between few words) and boilerplate (a short line with a stock phrase).  Lines that fail go, and a document
that keeps less than half of its characters in words goes whole.  A few counts over the whole document come with it.

Defined results: a null or blank text has no lines and keeps nothing; repeated rows get equal results; an empty table
gives no rows; other columns pass through ``clean`` whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import small_batches, table

SYMBOLS = b"#*$%&|<>"
#: Words of a window whose repeats count.
WINDOW = 8
#: A document is rejected if less than this share of its word characters is in lines that stay.
KEEP_SHARE = 0.5

#: Signs that end a sentence in Latin and Cyrillic; East Asian; Indic; Arabic; Armenian, Ethiopic, Khmer and Burmese writing.
STOPS = ("[.!?:;]", "…", "。", "｡", "．", "！", "？", "：", "；", "।", "॥", "۔", "؟", "؛", "։", "።", "፧", "។", "။")
#: Quotes and brackets that may follow.
CLOSERS = ("[\"')\\]]", "’", "”", "“", "»", "›", "」", "』", "）", "】", "》")
#: The end of a sentence, then quotes or brackets, then white space or the end.
ENDS = f"(?:{'|'.join(STOPS)})(?:{'|'.join(CLOSERS)})*(?:[ \\t\\r\\v\\f]|$)"
SYMBOL = r"[#*$%&|<>!~^=+{}\\@_\[\]]"
SEPARATORS = ("|", "/", ">", ">>", "-", "*", "•", "·", "»", "›")
#: Stock phrases in English, German, French and Spanish; letters A to Z match in either case.
BOILERPLATE = "|".join((
    "all rights reserved|licensed under|terms of (?:use|service)|privacy policy|cookie policy|uses cookies|enable javascript|click here|read more",
    "sign up|log ?in to|subscribe to|skip to (?:main )?content|powered by|lorem ipsum|copyright [0-9]|share (?:this|on)|page not found",
    "alle rechte vorbehalten|nutzungsbedingungen|datenschutzerkl(?:ä|ae)rung|verwendet cookies|javascript aktivieren|hier klicken|mehr lesen|weiterlesen|jetzt anmelden|zum inhalt springen|seite nicht gefunden",
    "tous droits r[ée]serv[ée]s|conditions d['’]utilisation|politique de confidentialit[ée]|mentions l[ée]gales|utilise des cookies|activez javascript|cliquez ici|lire la suite|aller au contenu|page introuvable",
    "todos los derechos reservados|t[ée]rminos de uso|pol[íi]tica de privacidad|aviso legal|utiliza cookies|active javascript|haga clic aqu[íi]|leer m[áa]s|ir al contenido|p[áa]gina no encontrada",
))
_either = lambda pattern: re.sub(r"\[([^\]\\]*[^\x00-\x7f][^\]\\]*)\]", lambda m: "(?:" + "|".join(m[1]) + ")", pattern)  # noqa: E731  # sets of characters, for bytes
_ENDS, _SYMBOL = re.compile(ENDS.encode()), re.compile(SYMBOL.encode())
_SEPARATORS = {x.encode() for x in SEPARATORS}
_BOILERPLATE = re.compile(b"(?i)" + _either(BOILERPLATE).encode())


def line_stays(line: bytes, words: list[bytes]) -> bool:
    """Whether one line of UTF-8, with its words, passes all rules."""
    n = len(words)
    seps = sum(w in _SEPARATORS for w in words)
    if seps >= 2 and seps * 5 >= n:
        return False
    size = sum(map(len, words))
    if len(_SYMBOL.findall(line)) * 10 > size and n > 1:
        return False
    if n > 10 and not _ENDS.search(line):
        return False
    return not (n <= 15 and _BOILERPLATE.search(line))


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, width: int = WINDOW) -> np.ndarray:
    """For each document: its words in windows of ``width`` words found there twice or more.  ``ids``: equal iff the words are."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(n_docs, np.int64)
    mix = np.random.default_rng(5).integers(1, 2**63, width + 1, dtype=np.uint64) | np.uint64(1)
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    if not len(at):
        return np.zeros(n_docs, np.int64)
    word = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    word ^= word >> np.uint64(29)
    key = doc[at].astype(np.uint64) * mix[width]
    for k in range(width):
        key += word[at + k] * mix[k]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    true = doc[at[same]] == doc[at[same + 1]]
    for k in range(width):
        true &= ids[at[same] + k] == ids[at[same + 1] + k]
    if not true.all():  # keys of different windows met: compare the windows themselves
        rows = np.stack([doc[at], *(ids[at + k] for k in range(width))])
        order = np.lexsort(rows[::-1])
        at = at[order]
        same = np.flatnonzero((rows[:, order][:, 1:] == rows[:, order][:, :-1]).all(axis=0))
    found = np.unique(np.concatenate([at[same], at[same + 1]]))
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + width, -1)
    return np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n_docs).astype(np.int64)


def measure(texts: list[bytes | None]) -> tuple[dict[str, np.ndarray], list[bytes]]:
    """Counts and verdicts of texts, and their cleaned texts."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    out = {x: np.zeros(len(texts), np.int64) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "kept_chars")}
    ids, clean = [], []
    for i, text in enumerate(texts):
        text = text or b""
        lines = [(x, w) for x in text.split(b"\n") if (w := x.split())]
        words = text.split()
        stay = [x for x, w in lines if line_stays(x, w)]
        ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        out["n_words"][i] = len(words)
        out["word_chars"][i] = len(b"".join(words).decode())
        out["n_symbols"][i] = sum(map(text.count, [SYMBOLS[k : k + 1] for k in range(len(SYMBOLS))]))
        out["n_dup_lines"][i] = len(lines) - len({x for x, _ in lines})
        out["kept_chars"][i] = out["word_chars"][i] if len(stay) == len(lines) else sum(len(b"".join(x.split()).decode()) for x in stay)
        clean.append(b"\n".join(stay))
    doc = np.repeat(np.arange(len(texts)), out["n_words"])
    out["n_repeat_words"] = repeated_words(np.concatenate(ids) if ids else np.zeros(0, np.int64), doc, len(texts))
    out["base_failed"] = (out["n_words"] < 20) | (100 * out["n_repeat_words"] > 30 * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["kept_chars"] >= KEEP_SHARE * out["word_chars"])
    return out, clean


FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, kept_chars long, base_failed boolean, kept boolean"
#: Bytes of text measured together.
TOGETHER = 8_000_000


def judged(df: DataFrame, text: str, texts: bool = True) -> DataFrame:
    """``df`` (columns of ours) with FIELDS and, if wanted, ``clean_text``."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)
    names = [x.split()[0] for x in FIELDS.split(", ")]

    def parts(raw: list[bytes | None]) -> Iterator[list[bytes | None]]:
        part, size = [], 0
        for x in raw:
            part.append(x)
            size += len(x or b"")
            if size >= TOGETHER:
                yield part
                part, size = [], 0
        yield part

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [measure(x) for x in parts(b.column(at).cast(pa.binary()).to_pylist())]
            new = [pa.array(np.concatenate([m[x] for m, _ in found])) for x in names]
            if texts:
                new.append(pa.array([x for _, c in found for x in c], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*(x for k, x in enumerate(b.columns) if texts or k != at), *new], names=[x.name for x in out])

    out = StructType([*(f for f in df.schema.fields if texts or f.name != text), *StructType.fromDDL(FIELDS).fields, *([StructField("clean_text", StringType())] if texts else [])])
    return df.mapInArrow(over, out)


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents that stay, with the columns of ``df``; ``text`` holds the lines that passed."""
    rows = judged(df.select(F.struct("*").alias("row"), F.col(text).alias("text")), "text").where("kept")
    return rows.select(*[F.col("clean_text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", texts=False)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_WORD = r"'[^\x20\x09-\x0D]+'"
_REPEAT = " || ' ' || ".join(["x"] + [f"lead(x, {k}) OVER w" for k in range(1, WINDOW)])
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
split AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, line, regexp_extract_all(line, {_WORD}) AS words FROM split),
ruled AS (
  SELECT doc_id, line, words, len(words) AS n, len(list_filter(words, lambda x: x IN ({', '.join(map(_text, SEPARATORS))}))) AS seps,
         strlen(array_to_string(words, '')) AS size, len(regexp_extract_all(line, {_text(SYMBOL)})) AS symbols
  FROM lines WHERE len(words) > 0),
judged AS (
  SELECT *, NOT (seps >= 2 AND seps * 5 >= n) AND NOT (symbols * 10 > size AND n > 1) AND NOT (n > 10 AND NOT regexp_matches(line, {_text(ENDS)}))
         AND NOT (n <= 15 AND regexp_matches(line, {_text('(?i)' + BOILERPLATE)})) AS stays FROM ruled),
by_lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN stays THEN length(array_to_string(words, '')) ELSE 0 END) AS kept_chars FROM judged GROUP BY doc_id),
flat AS (SELECT doc_id, unnest(words) AS x, unnest(range(len(words))) AS i FROM d),
windows AS (SELECT doc_id, i, {_REPEAT} AS s FROM flat WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM windows WHERE s IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range({WINDOW}) AS r(k) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(t, {_text('[' + SYMBOLS.decode() + ']')})) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, coalesce(kept_chars, 0) AS kept_chars
  FROM d LEFT JOIN by_lines USING (doc_id) LEFT JOIN repeats USING (doc_id))
SELECT * EXCLUDE (kept_chars), n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND kept_chars >= {KEEP_SHARE} * word_chars AS kept
FROM base
"""
