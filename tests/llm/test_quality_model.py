"""The parts of the quality model against brute force."""

import re

import numpy as np
import pytest

from tidemark.llm import quality_model as q

TEXTS = [None, b"", b"One two two TWO 3rd -- \xc3\xa9t\xc3\xa9! one", b"a", b"one two two", b"x" * 300 + b" word"]


def grams(text):
    """The n-grams that are features: of words in lower case, and of shapes with whether the word repeats the one before."""
    w = (text or b"").split()

    def shape(x):
        kind = "".join("A" if 65 <= c <= 90 else "a" if 97 <= c <= 122 or c >= 128 else "0" if 48 <= c <= 57 else chr(c) for c in x)
        return re.sub(r"(.)\1+", r"\1", kind)

    lower, shapes = [x.lower() for x in w], [(shape(x), k > 0 and w[k - 1] == x) for k, x in enumerate(w)]
    return {("w", *lower[k : k + n]) for n in (1, 2) for k in range(len(w) - n + 1)} | {("s", *shapes[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)}


def test_features():
    """As many as there are n-grams, equal for equal n-grams, whatever stands beside; all but a few hashes differ."""
    text, feature = q.features(TEXTS)
    of = [set(feature[text == i].tolist()) for i in range(len(TEXTS))]
    want = [grams(x) for x in TEXTS]
    assert [len(x) for x in of] == [len(x) for x in want]
    for i in range(len(TEXTS)):
        for j in range(len(TEXTS)):
            assert len(of[i] & of[j]) == len(want[i] & want[j])
    parts = q.features_in_parts(TEXTS, together=20)
    assert np.array_equal(parts[0], text) and np.array_equal(parts[1], feature)


def test_dual_descent_is_at_the_optimum():
    """The primal objective of the weights is that of the best found by other means: no step along any axis lowers it."""
    drawn = np.random.default_rng(1)
    x = drawn.normal(size=(60, 4)) * (drawn.random((60, 4)) < 0.7)
    y = np.where(x @ [1.0, -2.0, 0.5, 0.0] + 0.3 * drawn.normal(size=60) > 0.1, 1.0, -1.0)
    rows = [(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in x]
    c = np.full(60, 0.7)
    w = q.dual_descent(rows, y, 4, c, epochs=2000)
    cost = lambda w: 0.5 * w @ w + float(c @ np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])))
    here = cost(w)
    for _ in range(3000):
        assert cost(w + drawn.normal(size=5) * drawn.choice([1e-3, 1e-2, 0.1, 1.0])) >= here * (1 - 1e-3)  # it stops when no step moves by more than 1e-3


def test_calibration_is_at_the_optimum():
    drawn = np.random.default_rng(2)
    margin = drawn.normal(size=400)
    label = (drawn.random(400) < 1 / (1 + np.exp(-(2.5 * margin - 0.5)))).astype(float)
    weight = drawn.random(400)
    a, b = q.calibrate(margin, label, weight)
    loss = lambda a, b: float(weight @ np.log1p(np.exp(np.where(label == 1, -1, 1) * (a * margin + b)))) + 0.005 * ((a - 1) ** 2 + b**2)
    assert all(loss(a + d, b + e) >= loss(a, b) for d in (-1e-3, 0, 1e-3) for e in (-1e-3, 0, 1e-3)) and 1.5 < a < 4


def test_scale_and_score_of_a_small_fit():
    """The ratios are those of smoothed counts in the fitted rows, and scores follow from them."""
    texts = [b"good fine words here", b"bad junk $$$ here"] * 10
    label = np.array([1, 0] * 10)
    model = q.fit(texts, label, 0.5)
    fitted = [i for i in range(20) if i % 5 != 4]
    count = {k: {} for k in (0, 1)}
    text, feature = q.features(texts)
    for t, f in zip(text.tolist(), feature.tolist()):
        if t in fitted:
            count[label[t]][f] = count[label[t]].get(f, 0) + 1
    total = {k: sum(count[k].values()) + q.FEATURES for k in (0, 1)}
    for f in set(count[0]) | set(count[1]):
        want = np.log((count[1].get(f, 0) + 1) / total[1]) - np.log((count[0].get(f, 0) + 1) / total[0])
        assert model.scale[f] == pytest.approx(want, abs=1e-5)
    got = model.scores([*texts[:2], None])
    assert got[0] > 0.5 > got[1] and 0 < got[2] < 1


def test_bytes_of_the_sample_are_bounded(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + "w " * 500) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    real = q.fit
    try:
        q.fit = lambda texts, label, share: seen.append((sum(map(len, texts)), set(label.tolist()))) or real(texts, label, share)
        q.train(docs, labels, sample_bytes=8000)
        q.train(docs, labels, sample_bytes=10)
    finally:
        q.fit = real
    assert seen[0][0] <= 8000 and seen[0][1] == {0, 1} and seen[1][0] <= 2 * 1100 and seen[1][1] == {0, 1}
