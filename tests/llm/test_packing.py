"""Where packing may cut."""

import numpy as np

from tidemark.llm import packing


def inside(sizes, sentences, length):
    """Cuts that are no end of a document or sentence, after a check that all windows fit."""
    place, penalty = packing.candidates(sizes, [list(s) for s in sentences], length)
    cut = packing.cuts(place, penalty, length)
    assert cut[0] == 0 and cut[-1] == sum(sizes) and all(0 < b - a <= length for a, b in zip(cut, cut[1:]))
    ends = np.cumsum(sizes)
    good = {*ends.tolist(), *(int(e - n + x) for e, n, s in zip(ends, sizes, sentences) for x in s)}
    return [x for x in cut[1:] if x not in good]


def test_no_cut_inside_a_sentence_that_fits():
    # a full window of 2048 would end inside a sentence of 150 tokens
    assert inside([15_001, 777], [range(150, 15_001, 150), [400]], 2048) == []


def test_cuts_inside_a_sentence_longer_than_a_window():
    found = inside([100, 5000, 300], [[50], [200, 4900], []], 2048)
    assert found and all(300 < x < 5000 for x in found)
    assert inside([1, 70, 3], [[], [], []], 32)
    assert inside([1, 70, 3], [[], [], []], 7)
