"""A quality classifier: naive Bayes support vectors over n-grams.

Features are indicators of hashed n-grams of a text: of words (lower-case, n = 1, 2) and of word shapes (runs of capital
letters, small letters, digits and each other character, and whether the word repeats the one before; n = 1, 2, 3).
Each indicator is scaled by the log ratio of its smoothed counts in the two classes, rows get length 1, and a linear
hinge-loss model is fitted by dual coordinate descent.  A fifth of the sample, kept out of the fit, calibrates margins
to probabilities, with the classes weighted to their shares among all labels.

The fit takes at most ``SAMPLE`` labelled rows of each class, those of the smallest hashes of their ids, and of these the
first whose texts have ``SAMPLE_BYTES`` / 2 bytes together (one at least); that bounds the broadcast of ids, what the driver
gathers, and the driver's time.  The model is 2**18 numbers.  Scoring reads every
whole text and shuffles nothing.

Defined results: a null or blank text has only the bias, and so a score; null labels and labels of null ids are not
used, and of an id's several labels the smallest counts; without labels of both classes all scores are the share of
label 1 (1/2 without any).  Repeated rows get equal scores; other columns pass through ``keep``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import small_batches, table

#: Labelled rows of each class that the fit takes at most.
SAMPLE = 4000
#: Bytes of their texts at most.
SAMPLE_BYTES = 24_000_000
#: Features, rounds of the descent, and its bound of a row's weight.
FEATURES, EPOCHS, C = 1 << 18, 12, 1.0
#: Bytes of text whose features are made together.
TOGETHER = 2_000_000

_SHAPE = bytes.maketrans(bytes(range(128, 256)) + b"bcdefghijklmnopqrstuvwxyz" + b"BCDEFGHIJKLMNOPQRSTUVWXYZ" + b"123456789", b"a" * 128 + b"a" * 25 + b"A" * 25 + b"0" * 9)
_RUN = re.compile(rb"(.)\1+", re.S)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all indicators, sorted and without repeats."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    lists = [(x or b"").split() for x in texts]
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(lists)), np.int64, int(size.sum()))
    text = np.repeat(np.arange(len(texts)), size)
    hashed = lambda what: np.fromiter((xxhash.xxh64_intdigest(what(w)) for w in number), np.uint64, len(number))[ids]
    word, shape = hashed(bytes.lower), hashed(lambda w: _RUN.sub(rb"\1", w.translate(_SHAPE)))
    again = np.r_[False, (ids[1:] == ids[:-1]) & (text[1:] == text[:-1])] if len(ids) else np.zeros(0, bool)
    shape = shape + again * _ODD[3]
    found = []
    for kind, grams, longest in ((1, word, 2), (2, shape, 3)):
        key = np.zeros(len(ids), np.uint64)
        for n in range(1, longest + 1):
            m = len(ids) - n + 1
            if m <= 0:
                break
            key = (key[:m] * _ODD[0] + grams[n - 1 :]) * _ODD[1]
            key ^= key >> np.uint64(29)
            own = (key * _ODD[2] + _ODD[4] // np.uint64(10 * kind + n)) >> np.uint64(46)
            inside = text[:m] == text[n - 1 :]
            found.append(text[:m][inside] * FEATURES + own[inside].astype(np.int64))
    every = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return every // FEATURES, every % FEATURES


def features_in_parts(texts: list[bytes | None], together: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """``features`` of many texts, taken together only up to so many bytes, as that bounds what is held besides the result."""
    found, begin, size = [], 0, 0
    for i, x in enumerate(texts, 1):
        size += len(x or b"")
        if size >= together or i == len(texts):
            text, feature = features(texts[begin:i])
            found.append(((text + begin).astype(np.int32), feature.astype(np.int32)))
            begin, size = i, 0
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, c: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> np.ndarray:
    """Weights (the last is the bias) of the linear hinge-loss model of sparse rows (features, values) and labels of -1 and 1."""
    w = np.zeros(size + 1)
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            gradient = y[i] * (w[at] @ v + w[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), c[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[at] += step * v
                w[-1] += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def calibrate(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """a, b of the weighted logistic regression of labels (0, 1) on margins, by Newton's steps with a small ridge."""
    p = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(p @ x, -30, 30)))
        gradient = x @ (weight * (q - label)) + np.array([1e-2, 1e-2]) * (p - [1.0, 0.0])
        curve = (x * (weight * q * (1 - q))) @ x.T + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        p = p - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(p[0], 1e-3)), float(p[1])


class Model:
    """scale: log-count ratios; weight: of the scaled indicators; margins go to a * margin + b as log odds."""

    def __init__(self, scale: np.ndarray, weight: np.ndarray, bias: float, a: float, b: float):
        self.scale, self.weight, self.bias, self.a, self.b = scale.astype(np.float32), weight.astype(np.float32), bias, a, b

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        text, feature = features(texts)
        s = self.scale[feature].astype(float)
        length = np.sqrt(np.maximum(np.bincount(text, s * s, minlength=len(texts)), 1e-12))
        margin = np.bincount(text, s * self.weight[feature], minlength=len(texts)) / length + self.bias
        return 1 / (1 + np.exp(-np.clip(self.a * margin + self.b, -500, 500)))


def fit(texts: list[bytes | None], label: np.ndarray, share: float) -> Model:
    """The model of a sample of texts with labels 0 and 1, where ``share`` of all labels are 1."""
    if len(set(label.tolist())) < 2:
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0, float(odds))
    text, feature = features_in_parts(texts)
    aside = np.arange(len(texts)) % 5 == 4  # texts come in the order of a hash
    if len(set(label[aside].tolist())) < 2 or len(set(label[~aside].tolist())) < 2:
        aside[:] = False
    of = label[text]
    use = ~aside[text]
    counts = [np.bincount(feature[use & (of == k)], minlength=FEATURES) + 1.0 for k in (0, 1)]
    scale = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    begin = np.searchsorted(text, np.arange(len(texts) + 1))
    rows = []
    for i in range(len(texts)):
        at = feature[begin[i] : begin[i + 1]]
        v = scale[at]
        rows.append((at, v / max(np.sqrt(v @ v), 1e-6)))
    fitted = np.flatnonzero(~aside)
    y = np.where(label == 1, 1.0, -1.0)
    weight = dual_descent([rows[i] for i in fitted], y[fitted], FEATURES, np.full(len(fitted), C))
    test = np.flatnonzero(aside) if aside.any() else fitted
    margin = np.array([weight[rows[i][0]] @ rows[i][1] + weight[-1] for i in test])
    truth = label[test].astype(float)
    even = np.where(truth == 1, share / max(truth.mean(), 1e-9), (1 - share) / max(1 - truth.mean(), 1e-9))
    a, b = calibrate(margin, truth, even)
    return Model(scale, weight[:-1], float(weight[-1]), a, b)


def held_out(id: Column) -> Column:
    """Whether a row's labels are never learnt from: the CRC-32 of its id as text is divisible by 5 (a null id: no)."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    known = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).where("id IS NOT NULL AND label IN (0, 1)").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = n.get(1, 0) / sum(n.values()) if n else 0.5
    order = [F.xxhash64("id"), F.col("id")]
    some = known.where("label = 0").orderBy(*order).limit(sample).unionByName(known.where("label = 1").orderBy(*order).limit(sample))
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text")).join(F.broadcast(some), "id")
    # of repeated ids one row; at most 2 * sample rows, and sample_bytes bytes but for a first row, come to the driver
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text"))
    first = Window.partitionBy("label").orderBy(*order)  # sample rows
    rows = rows.withColumn("no", F.row_number().over(first)).withColumn("so_far", F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(first.rowsBetween(Window.unboundedPreceding, 0)))
    got = rows.where((F.col("no") == 1) | (F.col("so_far") <= sample_bytes // 2)).select("id", "label", "text").orderBy(*order).toArrow()
    return fit(got.column("text").to_pylist(), got.column("label").to_numpy().astype(int), share)


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 of each text, added as ``name``."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)
    held = df.sparkSession.sparkContext.broadcast(model)

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
            found = [held.value.scores(x) for x in parts(b.column(at).cast(pa.binary()).to_pylist()) if x]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(found) if found else [], pa.float64())], names=[*b.schema.names, name])

    return df.mapInArrow(over, StructType([*df.schema.fields, StructField(name, DoubleType())]))


def keep(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``df`` with a score of ``threshold`` or more, with its columns."""
    rows = df.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return score(rows, model).where(F.col("score") >= threshold).select("row.*")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
