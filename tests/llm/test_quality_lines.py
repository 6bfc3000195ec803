"""The rule for the ends of lines, in several scripts, here and in SQL."""

import duckdb
import pytest

from tidemark.llm import quality_rules

WORDS = "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf"
GOOD = [".", "?", "!”", "。", "。」", "｡", "！", "？）", "।", "॥ ", "۔", "؟", "؛", "։", "።", "។", "။", "…»", ". Und", ".\r", ";"]
BAD = ["", ",", "、", "،", "-", "”", "」", ".a", "۔a", "一", "ß"]


@pytest.mark.parametrize("end,stays", [(x, True) for x in GOOD] + [(x, False) for x in BAD])
def test_a_long_line_ends_with_a_sentence(end, stays):
    line = WORDS + end
    assert quality_rules.line_stays(line.encode(), line.encode().split()) == stays
    assert duckdb.execute("SELECT regexp_matches(?, ?)", [line, quality_rules.ENDS]).fetchone() == (stays,)
