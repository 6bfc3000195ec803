"""Row images from redo statements, with SQL functions only.

A statement is cut into tokens once: gaps (blanks and comments), typed literals, strings, quoted names, numbers, words, and signs.
Then brackets of expressions are put together, to any depth: a walk over the brackets alone counts how deep each is, and
what an outermost one holds, with the name of a call in front, becomes one token.  What stands between commas or conditions is a
slice of the tokens: a single one is a literal or a name, more are an expression, kept as its text.  Only ``=`` gives an equality of
a condition; of a name that comes twice the last value holds.  Images are maps from column names to texts; a column that the
statement compares with IS NULL is absent.  How wide a gap is never changes an image.  What is not understood is not parsed, never
parsed wrongly.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import UPDATE

_STRING, _NAME = r"'(?:[^']++|'')*+'", r'"[^"]*+"'
_GAP = r"(?:\s++|--[^\n]*+|/\*(?s:.*?)\*/)++"
#: With the gap in front: literals with a type or a prefix; strings; names; numbers; words; signs; or the end.
TOKEN = rf"(?i)(?:{_GAP})?+(" + "|".join((
    rf"\b(?:TIMESTAMP|DATE)\s*+{_STRING}", rf"(?:\b[NU])?{_STRING}", _NAME, r"\d[\d.]*+(?:e[+-]?\d++)?(?![\w$#])", r"[\w$#.@]++", r"\|\||[<>!^]=|<>|[^\s\w]", r"\z",
)) + ")"
#: No brackets, or an insert whose two lists hold none: nothing is to be put together.
_PLAIN = r"(?i)\A(?:\s*+insert\b[^()]*+\([^()]*+\)[^()]*+\([^()]*+\))?+[^()]*+\z"
_LITERAL, _TABLE, _AND = rf"(?:(?:(?:TIMESTAMP|DATE)\s*+)?+{_STRING}|NULL)", rf"{_NAME}\.{_NAME}", r"\s++and\s++"
_SET, _TEST = rf"{_NAME}\s*+=\s*+{_LITERAL}", rf"{_NAME}(?:\s*+=\s*+{_LITERAL}|\s++IS\s++NULL)"
_LIST = lambda item: rf"\s*+\(\s*+{item}(?:\s*+,\s*+{item})*+\s*+\)"
#: Statements as a log writes them where all values are literals: each name, sign and value is one token, at a place that can be told.
USUAL = (
    rf"\A(?:insert\s++into\s++{_TABLE}{_LIST(_NAME)}\s*+values{_LIST(_LITERAL)}"
    rf"|(?:delete\s++from\s++{_TABLE}|update\s++{_TABLE}\s++set\s++{_SET}(?:\s*+,\s*+{_SET})*+)\s++where\s++{_TEST}(?:{_AND}{_TEST})*+)\s*+;?+\s*+\z"
)
#: Words and signs after which a bracket of a condition groups conditions; after others it belongs to an expression.
_GROUPS = ("where", "and", "or", "not", "set", "(")
_WALK = "struct<depth:int,inside:int,start:int,closed:boolean,found:array<struct<first:int,last:int>>>"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once: a lambda's variable is never put back as its expression."""
    # an element_at knows its type; a get asks all expressions below for theirs again for each row
    return F.try_element_at(F.transform(F.array(value), then), F.lit(1))


def _bracket(t: Column, x: Column, i: Column) -> Column:
    """A bracket at place i (from 0) of tokens: the sign, its place from 1, and the token in front of it."""
    return F.struct(x.alias("sign"), (i + 1).alias("at"), F.lower(F.coalesce(F.get(t, i - 1), F.lit(""))).alias("before"))


def _walk(insert: Column, acc: Column, b: Column) -> Column:
    """One bracket further: how deep, from which depth and place on an expression's bracket is open, and those found so far."""
    depth, inside, start, closed, found = (acc[x] for x in ("depth", "inside", "start", "closed", "found"))
    opens = b["sign"] == "("
    # an insert's outer brackets are its lists
    begins = (inside == 0) & opens & F.when(insert, depth > 0).otherwise(~b["before"].isin(*_GROUPS))
    ends = ~opens & (inside > 0) & (inside == depth)
    called = b["before"].rlike(r"^[\w$#.]+$") & ~b["before"].isin("and", "or", "not", "values")
    return F.when(begins, F.struct((depth + 1).alias("depth"), (depth + 1).alias("inside"), F.when(called, b["at"] - 1).otherwise(b["at"]).alias("start"), closed.alias("closed"), found.alias("found")).cast(_WALK)).when(
        ends, F.struct((depth - 1).alias("depth"), F.lit(0).alias("inside"), start.alias("start"), (closed & (depth > 0)).alias("closed"), F.array_append(found, F.struct(start.alias("first"), b["at"].alias("last"))).alias("found")).cast(_WALK)
    ).otherwise(F.struct(F.when(opens, depth + 1).otherwise(depth - 1).alias("depth"), inside.alias("inside"), start.alias("start"), (closed & (opens | (depth > 0))).alias("closed"), found.alias("found")).cast(_WALK))


def _fold(spaced: Column, t: Column, walked: Column) -> Column:
    """Tokens with one for each expression's bracket; null if brackets don't match."""
    text = lambda g: F.ltrim(F.array_join(F.slice(spaced, g["first"], g["last"] - g["first"] + 1), ""))
    last = lambda found, k: F.coalesce(F.get(found, k - 1)["last"], F.lit(0))
    between = lambda found, k, stop: _let(last(found, k), lambda x: F.slice(t, x + 1, stop - x - 1))
    parts = lambda found: F.concat(F.flatten(F.transform(found, lambda g, k: F.array_append(between(found, k, g["first"]), text(g)))), between(found, F.size(found), F.size(t) + 1))
    return F.when(walked["closed"] & (walked["depth"] == 0), F.when(F.size(walked["found"]) > 0, parts(walked["found"])).otherwise(t))


def tokens(sql: Column, usual: Column) -> Column:
    """The tokens of a statement, without gaps and a semicolon at the end, each bracket of an expression as one; null if brackets don't match
    (``_PLAIN`` statements are not looked at for that: their brackets are counted, see ``_images``)."""
    none = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("inside"), F.lit(0).alias("start"), F.lit(True).alias("closed"), F.array().alias("found")).cast(_WALK)

    def walked(spaced: Column, t: Column) -> Column:
        brackets = F.array_compact(F.transform(t, lambda x, i: F.when(x.isin("(", ")"), _bracket(t, x, i))))
        insert = lambda done: F.aggregate(brackets, none, lambda acc, b: _walk(done, acc, b))
        return _let(_let(F.lower(F.coalesce(F.get(t, F.lit(0)), F.lit(""))) == "insert", insert), lambda w: _fold(spaced, t, w))

    def folded(found: Column) -> Column:
        gap = lambda x: (x < "!") | x.startswith("--") | x.startswith("/*")
        # a gap is one blank in front of its token
        blank = F.transform(found, lambda x: F.when(gap(x), F.regexp_replace(x, rf"\A{_GAP}", " ")).otherwise(x))
        bare = lambda spaced: F.transform(spaced, lambda x: F.when(x.startswith(" "), F.substr(x, F.lit(2))).otherwise(x))
        return _let(F.filter(blank, lambda x: ~x.isin("", " ", ";", " ;")), lambda spaced: _let(bare(spaced), lambda t: walked(spaced, t)))

    def of(plain: Column) -> Column:
        found = F.regexp_extract_all(sql, F.lit(TOKEN), F.when(plain, 1).otherwise(0))
        return _let(found, lambda x: F.when(plain, F.filter(x, lambda y: ~y.isin("", ";"))).otherwise(folded(x)))

    return _let(usual | F.coalesce(sql.rlike(_PLAIN), F.lit(True)), of)


def _inner(token: Column) -> Column:
    """A token without its first and last character."""
    return F.substr(token, F.lit(2), F.length(token) - 2)


def decode_literal(token: Column) -> Column:
    """NULL is null; of a date, timestamp or string the text inside; of a name the name; anything else as it stands."""

    def decoded(x: Column) -> Column:
        inside = F.replace(F.regexp_extract(x, r"(?s)'(.*)'$", 1), F.lit("''"), F.lit("'"))
        return (
            F.when(x.startswith("'") & x.endswith("'"), F.replace(_inner(x), F.lit("''"), F.lit("'"))).when((F.length(x) == 4) & (F.upper(x) == "NULL"), F.lit(None).cast("string")).when(x.rlike("(?i)^[NU]?'"), inside)
            .when(x.rlike(r"(?i)^(?:TIMESTAMP|DATE)\s*'"), F.ltrim(inside)).when(x.startswith('"') & x.endswith('"'), _inner(x)).when(x.startswith('"'), F.regexp_replace(x, '^"|"$', "")).otherwise(x)
        )

    return _let(token, decoded)


def _text(part: Column) -> Column:
    """The value that some tokens stand for: of one its literal, of more their text (null for none)."""

    def of(p: Column) -> Column:
        # a sign in front belongs to what comes after it
        signed = F.concat(F.array(F.concat(p[0], F.get(p, F.lit(1)))), F.slice(p, 3, F.greatest(F.size(p) - 2, F.lit(0))))
        joined = F.array_join(F.when(p[0].isin("-", "+") & (F.size(p) > 1), signed).otherwise(p), " ")
        return F.when(F.size(p) == 1, decode_literal(p[0])).when(F.size(p) > 1, joined)

    return _let(part, of)


def _name(part: Column) -> Column:
    """The column that tokens name: of a qualified name the last."""
    of = lambda p: _let(F.try_element_at(p, F.lit(-1)), lambda last: F.when(last.startswith('"'), decode_literal(last)).otherwise(F.array_join(p, " ")))
    return _let(part, of)


def _between(array: Column, first: Column, stop: Column) -> Column:
    """The elements from ``first`` up to ``stop``, counted from 1, without the second."""
    return F.slice(array, F.greatest(first, F.lit(1)), F.greatest(stop - first, F.lit(0)).cast("int"))


def _split(part: Column, is_cut) -> Column:
    """The runs of tokens between those that ``is_cut`` takes; an empty list of tokens is one empty run."""

    def of(p: Column) -> Column:
        ends = F.array_append(F.array_compact(F.transform(p, lambda x, i: F.when(is_cut(x), i + 1))), F.size(p) + 1)
        return _let(ends, lambda e: F.transform(e, lambda stop, k: _let(F.coalesce(F.get(e, k - 1), F.lit(0)) + 1, lambda first: F.slice(p, first, stop - first))))

    return _let(part, of)


def _commas(part: Column) -> Column:
    return _split(part, lambda x: x == ",")


def _equality(part: Column) -> Column:
    """The name and value around the = of a run of tokens; a null name if there is none."""
    none = F.lit(None).cast("string")
    both = lambda at: F.struct(_name(_between(part, F.lit(1), at)).alias("name"), _text(_between(part, at + 1, F.size(part) + 1)).alias("value"))
    return _let(F.array_position(part, "=").cast("int"), lambda at: F.when((at > 1) & (at < F.size(part)), both(at)).otherwise(F.struct(none.alias("name"), none.alias("value"))))


def _map(pairs: Column) -> Column:
    """A map of pairs; of a name that comes twice the last value."""
    named = lambda p: F.transform(p, lambda x: x["name"])
    last = lambda p: F.filter(p, lambda x, i: ~F.array_contains(named(F.slice(p, i + 2, F.size(p))), x["name"]))
    one = _let(pairs, lambda p: F.when(F.size(F.array_distinct(named(p))) < F.size(p), last(p)).otherwise(p))
    return F.map_from_entries(one)


def _places(low: Column) -> Column:
    at = lambda word: F.array_position(low, word).cast("int")
    return F.struct(F.try_element_at(low, F.lit(1)).alias("kind"), at("(").alias("opens"), at("values").alias("values"), at("set").alias("sets"), at("where").alias("where"))


def _parts(t: Column, at: Column) -> Column:
    """The runs of tokens of a statement: names and items of an insert, assignments and conditions of the others."""
    end, opens, values, sets, where = F.size(t) + 1, at["opens"], at["values"], at["sets"], at["where"]
    insert, update = at["kind"] == "insert", at["kind"] == "update"
    separates = lambda x: F.lower(x).isin("and", "or", "not", "(", ")")
    return F.struct(
        F.when(insert, _commas(_between(t, opens + 1, values - 1))).alias("names"), F.when(insert, _commas(_between(t, values + 2, end - 1))).alias("items"),
        F.when(update & (sets > 0), _commas(_between(t, sets + 1, F.when(where > 0, where).otherwise(end)))).alias("new"),
        F.when(~insert & (where > 0), F.filter(F.transform(_split(_between(t, where + 1, end), separates), _equality), lambda x: x["name"].isNotNull())).alias("old"),
    )


def _pairs(at: Column, part: Column) -> Column:
    zipped = F.zip_with(part["names"], part["items"], lambda a, b: F.struct(_name(a).alias("name"), _text(b).alias("value")))
    return F.struct(F.when(at["kind"] == "insert", zipped).otherwise(F.transform(part["new"], _equality)).alias("new"), part["old"].alias("old"))


def _images(t: Column, at: Column, part: Column, pairs: Column) -> Column:
    opens, values, sets, where = at["opens"], at["values"], at["sets"], at["where"]
    n = lambda sign, tokens: F.size(F.filter(tokens, lambda x: x == sign))
    filled = lambda runs: ~F.exists(runs, lambda x: F.size(x) == 0)
    lists = (opens > 2) & (values > opens + 1) & (n("(", t) == 2) & (n(")", t) == 2) & (F.try_element_at(t, values + 1) == "(") & (F.try_element_at(t, values - 1) == ")")
    whole = lists & (F.try_element_at(t, F.lit(-1)) == ")") & (F.size(part["names"]) == F.size(part["items"])) & filled(part["names"]) & filled(part["items"])
    own = _between(t, F.lit(1), F.when(where > 0, where).otherwise(F.size(t) + 1))
    named = ~F.exists(pairs["new"], lambda x: x["name"].isNull())
    balanced = n("(", t) == n(")", t)
    ok = (
        F.when(at["kind"] == "insert", whole & named).when(at["kind"] == "update", (sets > 0) & (where > sets) & (n("(", own) == 0) & named & balanced)
        .when(at["kind"] == "delete", (where > 0) & balanced)
    )
    ok = F.coalesce(ok, F.lit(False)) & ~F.array_contains(t, "'") & ~F.array_contains(t, '"')

    def made(ok: Column) -> Column:
        before, after = F.when(ok & (at["kind"] != "insert"), _map(pairs["old"])), F.when(ok & (at["kind"] != "delete"), _map(pairs["new"]))
        return F.struct(before.alias("before"), after.alias("after"), ok.alias("parsed"))

    return _let(ok, made)


def _usual(t: Column) -> Column:
    """The images of a ``USUAL`` statement: names and values stand two tokens apart in lists, and four in assignments and conditions."""
    # names are whole tokens in quotes
    pair = lambda name, value: F.struct(_inner(F.get(t, name)).alias("name"), decode_literal(F.get(t, value)).alias("value"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)

    def inserted(n: Column) -> Column:
        # the first list ends there if both are of one length
        ok = (F.size(t) == n * 4 + 8) & (F.get(t, n * 2 + 5) == ")")
        after = lambda ok: F.struct(F.lit(None).cast("map<string,string>").alias("before"), F.when(ok, _map(F.transform(upto(n), lambda i: pair(i * 2 + 6, n * 2 + i * 2 + 8)))).alias("after"), ok.alias("parsed"))
        return _let(ok, after)

    def changed(where: Column) -> Column:
        places = F.filter(F.sequence(where, F.size(t) - 1, F.lit(4)), lambda i: F.get(t, i + 1) == "=")
        assigned = F.transform(upto(F.floor((where - 5) / 4).cast("int")), lambda i: pair(i * 4 + 5, i * 4 + 7))
        return F.struct(_map(F.transform(places, lambda i: pair(i, i + 2))).alias("before"), F.when(t[0] == "update", _map(assigned)).alias("after"), F.lit(True).alias("parsed"))

    return F.when(t[0] == "insert", _let(F.floor((F.size(t) - 8) / 4).cast("int"), inserted)).otherwise(_let(F.array_position(t, "where").cast("int"), changed))


def images(sql: Column) -> Column:
    """A statement as struct<before, after, parsed>; it is cut into tokens once."""
    general = lambda t: _let(_places(F.transform(t, F.lower)), lambda at: _let(_parts(t, at), lambda part: _let(_pairs(at, part), lambda pairs: _images(t, at, part, pairs))))
    return _let(F.coalesce(sql.rlike(USUAL), F.lit(False)), lambda usual: _let(tokens(sql, usual), lambda t: F.when(usual, _usual(t)).otherwise(general(t))))


def parse(changes: DataFrame) -> DataFrame:
    """``changes`` with ``before`` and ``after``, and ``parsed``: whether the statement could be read.

    The images are generated, one for each row: no filter or projection above can be put below and so parse again.
    """
    return changes.select("*", _generator(changes.sparkSession.sparkContext.applicationId))


@lru_cache(maxsize=1)
def _generator(application: str) -> Column:
    """The generator of an application: some thousand calls make its expression, so it is made once and not in each batch of a stream."""
    return F.inline(F.array(images(F.col("sql_redo"))))


def spread(changes: DataFrame) -> DataFrame:
    """The same rows dealt evenly for parsing, which costs far more than a row's size tells: small partitions are not merged."""
    return changes.repartition(int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seq")


def drop_unparsable(changes: DataFrame) -> DataFrame:
    return parse(changes).where("parsed").drop("parsed")


def unparsable(changes: DataFrame) -> DataFrame:
    """The changes whose statements can't be read, to be kept apart (``plans.cdc.outcomes`` has them with a reason)."""
    return parse(changes).where("NOT parsed").select(*changes.columns)


def after_image(op_code: Column, before: Column, after: Column) -> Column:
    """Of updates the new image with the columns that did not change, from the old one; an explicit null stays null."""
    rest = F.map_filter(before, lambda k, _: ~F.map_contains_key(after, k))
    return F.when((op_code == UPDATE) & before.isNotNull() & after.isNotNull(), F.map_concat(after, rest)).otherwise(after)
