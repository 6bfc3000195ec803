"""Statements one by one, with the forms that a redo log may hold."""

import random

import pytest

from tidemark.operators import parse


def images(spark, *sql):
    out = parse.parse(spark.createDataFrame([(i, x) for i, x in enumerate(sql)], "seq long, sql_redo string")).orderBy("seq").collect()
    return [(r["before"], r["after"], r["parsed"]) for r in out]


NO = (None, None, False)


def test_statements(spark):
    got = images(
        spark,
        """insert into "SIT"."TEST_TAB"("ID","STRING","TIME") values ('1','it''s where "x"',TIMESTAMP ' 2020-01-13 15:45:01.000000')""",
        """update "SIT"."TEST_TAB" set "STRING" = NULL where "ID" = '1' and "STRING" = 'a where b' and "LONG" IS NULL""",
        """delete from "SIT"."TEST_TAB" where "ID" = '1' and "D" = DATE '2020-01-13'""",
        "alter table x move",
        "",
        None,
    )
    assert got[0] == (None, {"ID": "1", "STRING": 'it\'s where "x"', "TIME": "2020-01-13 15:45:01.000000"}, True)
    assert got[1] == ({"ID": "1", "STRING": "a where b"}, {"STRING": None}, True)
    assert got[2] == ({"ID": "1", "D": "2020-01-13"}, None, True)
    assert got[3:] == [NO] * 3


def test_expressions_are_kept_as_their_text(spark):
    got = images(
        spark,
        """update "T" set "A" = 'x' || 'y', "B" = NVL(TO_CHAR(1),'z'), "C" = 1 + 2, "D" = -5, "E" = 1.5e-3, "F" = HEXTORAW('AB'), "G" = (1 + (2 * 3)) where "ID" = '1';""",
        """insert into T(A, "B)", C, D, E) values (UNISTR('\\00e4') || UNISTR('\\00f6'), 'a),(b', f(g(h(1, ')'), "X"), 2), -1.5, NULL);""",
        """insert into "S"."T"("A") values ((1+2)*3)""",
        """insert into "S"."T"("A","B") values (EMPTY_CLOB(),N'ü')""",
    )
    assert got[0] == ({"ID": "1"}, {"A": "'x' || 'y'", "B": "NVL(TO_CHAR(1),'z')", "C": "1 + 2", "D": "-5", "E": "1.5e-3", "F": "HEXTORAW('AB')", "G": "(1 + (2 * 3))"}, True)
    assert got[1] == (None, {"A": "UNISTR('\\00e4') || UNISTR('\\00f6')", "B)": "a),(b", "C": "f(g(h(1, ')'), \"X\"), 2)", "D": "-1.5", "E": None}, True)
    assert got[2] == (None, {"A": "(1+2) * 3"}, True)
    assert got[3] == (None, {"A": "EMPTY_CLOB()", "B": "ü"}, True)


def test_only_equalities_of_conditions_count(spark):
    got = images(
        spark,
        """delete from "T" where "A" >= 5 and "B" <= 6 and "C" <> 7 and "D" != 8 and "E" > 9 and "F" = 10 and "G" between 1 and 2 and "H" like '=' and "I" in (1, 2)""",
        """delete from "T" where ("A" = 1 or "B" = 'x=y') and not ("C" = 3) and UPPER("D") = 'D' and ROWID = 'AAA'""",
        """delete from "T" where "T"."A" = 1 and "ID" = '1' and "ID" = '2'""",
        """update "T" set "A" = 1, "A" = 2 where "S"."T"."B" = f('=', 1) || 'c' -- set "A" = 9""",
        """/* insert */ delete from "T" where /* "X" = 1 and */ "A" = '--' and "B" = '/*'""",
    )
    assert got[0] == ({"F": "10"}, None, True)
    assert got[1] == ({"A": "1", "B": "x=y", "C": "3", 'UPPER("D")': "D", "ROWID": "AAA"}, None, True)
    assert got[2] == ({"A": "1", "ID": "2"}, None, True)
    assert got[3] == ({"B": "f('=', 1) || 'c'"}, {"A": "2"}, True)
    assert got[4] == ({"A": "--", "B": "/*"}, None, True)


def test_what_is_not_understood_is_not_parsed(spark):
    got = images(
        spark,
        """insert into "T"("A","B") values ('1',f((1))""", """insert into "T"("A","B") values ('1')""", """insert into "T" values ('1')""", """insert into "T"("A") select 1 from dual""",
        """insert into "T"("A","B") values ('1',)""", """insert into "T"("A","B") values ('1','2'""", """insert into "T"("A","B") values ('1','it''s)""", """update "T" set "A" where "B" = 1""",
        """update "T" set "A" = 1""", """update "T" set "A" = (1)) where "B" = (1""", """delete from "T\"""", """delete from "T" where ("A" = 1""",
    )
    assert got == [NO] * 12


def test_brackets_of_any_depth_after_any_gap(spark):
    deep = "(" * 300 + "1" + ")" * 300
    wide = " " * 12 + "\n\t/* ( */ "
    got = images(
        spark,
        f"""insert into "T"("A","B") values ('1',f{deep})""", f"""update "T" set "A" = {deep} where "B" = 1""", """update "T" set "A" =            (1 + 2) where "ID" = 5""",
        f"""update "T" set "A" ={wide}f{wide}(1,{wide}2){wide}where{wide}({wide}({wide}"ID" ={wide}5{wide}){wide}or not{wide}("X" = g{wide}(1)))""",
        f"""delete from "T" where{wide}UPPER{wide}("D") = 'D' and (("A" = 1)) and exists (select 1 from "U" where "Z" = 3) and "E" = 4""",
        """insert into T (A, B) values (1, (select max(x) from (select 1 x from dual where a in ('(', "(") ) ))""",
        """update "T" set "A" = "P"."F"(1) where "B" = 2""", """update "T" set ("A") = (1) where "B" = 2""", """delete from "T" where "A" = 1) or ("B" = 2""",
    )
    assert got[0] == (None, {"A": "1", "B": f"f{deep}"}, True) and got[1] == ({"B": "1"}, {"A": deep}, True) and got[2] == ({"ID": "5"}, {"A": "(1 + 2)"}, True)
    assert got[3] == ({"ID": "5", "X": "g (1)"}, {"A": "f (1, 2)"}, True)
    assert got[4] == ({'UPPER ("D")': "D", "A": "1", "E": "4"}, None, True)
    assert got[5] == (None, {"A": "1", "B": """(select max(x) from (select 1 x from dual where a in ('(', "(") ) )"""}, True)
    assert got[6] == ({"B": "2"}, {"A": '"P" . "F" (1)'}, True) and got[7:] == [NO] * 2


#: Statements by their tokens; a gap may stand between any two.
PARTS = [
    ["insert", "into", '"S"', ".", '"T"', "(", '"A"', ",", '"B"', ",", '"C"', ")", "values", "(", "'x ('' y'", ",", "NVL(a, 'b')", "+", "(1 * (2))", ",", "TIMESTAMP ' 2020-01-01 00:00:00'", ")"],
    ["update", '"T"', "set", '"A"', "=", "((1) || f(g(2)))", ",", '"B"', "=", "-", "5", "where", "(", '"ID"', "=", "'1'", "or", "not", "(", '"C"', "is", "null", ")", ")", "and", '"D"', "=", "h(1, (2))"],
    ["delete", "from", "T", "where", '"A"', "=", "1.5e-3", "and", "(", "B", "<>", "f(x)", ")", "and", "UPPER(\"C\")", "=", "N'c'", ";"],
]


def test_gaps_between_tokens_change_no_image(spark):
    drawn = random.Random(7)
    gap = lambda: "".join(drawn.choice((" ", "  ", "\n", "\t", "\x0b", "/* ' ( \" */", "-- it's )\n", " " * 40)) for _ in range(drawn.randint(1, 4)))
    # words need a gap between them, signs none; a minus next to a comment would be part of it
    spread = lambda parts: "".join(x + (" " * (x == "-") + gap() if drawn.random() < 0.7 or (x[-1].isalnum() and y[:1].isalnum()) or x + y in ("--", "/*") else "") for x, y in zip(parts, [*parts[1:], "("]))
    plain = images(spark, *[" ".join(p) for p in PARTS])
    assert all(p for *_, p in plain)
    many = images(spark, *[spread(p) for _ in range(60) for p in PARTS])
    assert many == plain * 60


@pytest.mark.parametrize("n, size", [(502, 4000), (1000, 10)])
def test_long_statement(spark, n, size):
    names, long = [f"C{i}" for i in range(n)], "a" * size
    sql = f"""insert into "S"."T"({",".join(f'"{x}"' for x in names)}) values ({",".join([f"'{long}'"] * n)})"""
    assert images(spark, sql) == [(None, dict.fromkeys(names, long), True)]
    sql = f"""update "S"."T" set {", ".join(f'"{x}" = f({k}) || 1' for k, x in enumerate(names))} where {" and ".join(f'"{x}" = {k}' for k, x in enumerate(names))}"""
    assert images(spark, sql) == [({x: str(k) for k, x in enumerate(names)}, {x: f"f({k}) || 1" for k, x in enumerate(names)}, True)]


def test_one_tokeniser_in_a_plan(spark):
    from tidemark.plans import queries as core

    plan = core.QUERIES["change_envelope"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_what_an_expression_uses_again_is_computed_once(spark):
    plan = parse.parse(spark.createDataFrame([(1, "x")], "seq long, sql_redo string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position(") < 20  # 100 when each use of a run's = looked for it again


def test_usual_statements_are_read_as_others(spark):
    """By places where all values are literals; a comment in front makes the same statement one that is searched."""
    import re

    usual = [
        """insert into "S"."T"("A","B","A") values ('it''s (a) where', NULL ,TIMESTAMP ' 2020-01-01 00:00:00');""", """insert into "S"."T"("A","B") values ('1')""", """insert into "S"."T"("A","B","C") values ('1')""",
        """update "S"."T" set "A" = 'x', "where"=NULL where "ID" = '1' and "B" IS NULL and "ID" = DATE '2020-01-01'""", """delete from "S"."T" where "" = '' and "B" IS NULL ; """, """delete from "S"."T" where "B" IS NULL""",
    ]
    assert all(re.match(parse.USUAL.replace(r"\z", r"\Z"), x) for x in usual)
    got = images(spark, *usual)
    assert got == images(spark, *["/**/" + x for x in usual])
    assert got[0] == (None, {"B": None, "A": "2020-01-01 00:00:00"}, True) and got[1:3] == [NO] * 2 and got[5] == ({}, None, True)
    assert got[3] == ({"ID": "2020-01-01"}, {"A": "x", "where": None}, True) and got[4] == ({"": ""}, None, True)
