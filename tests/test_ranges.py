"""Running sums by ranges against plain ones."""

import random

import pytest

from tidemark.operators.ranges import earlier


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
def test_what_comes_earlier(spark, levels):
    drawn = random.Random(levels)
    rows = [(p, drawn.randrange(5)) for p in drawn.sample(range(200), 90)]
    got = {r["place"]: r["before"] for r in earlier(spark.createDataFrame(rows, "place long, n long"), "place", "n", "before", levels, 2).collect()}
    assert got == {p: sum(n for q, n in rows if q < p) for p, _ in rows}
    assert earlier(spark.createDataFrame([], "place long, n long"), "place", "n", "before", levels, 2).isEmpty()
