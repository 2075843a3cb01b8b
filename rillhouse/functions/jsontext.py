"""JSON documents held as text.

Documents travel as strings until a layer knows their schema; these helpers
check, read and extend them without a Python function.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Drawn anew for each driver, so that no text can hold it, spelled out or escaped.
_MARK = "\ue000" + secrets.token_hex(12)


def is_json_object(value: Column) -> Column:
    """True when the whole text is exactly one JSON object.

    Spark's JSON functions ignore text after the first document.  Two wrappers
    close that gap: inside an array the text must form exactly one element, and
    as an object member it must be one object value.  No field is requested, so
    the parser only walks over the tokens.

    Nearly all texts are accepted by one parse before that: behind the text stands a mark that
    it cannot hold, and only one value in front makes that the second element.  What this does
    not accept (control characters, NaN, or no object at all) is judged by the wrappers.
    """
    followed = F.get_json_object(F.concat(F.lit("["), value, F.lit(f',"{_MARK}"]')), "$[1]")
    at_once = value.rlike(r"\A *\{[^\x00-\x1f]*+\z") & (followed == _MARK)
    in_array = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<struct<_:string>>")
    as_member = F.from_json(F.concat(F.lit('{"w":'), value, F.lit("}")), "w struct<_:string>")
    # one mark per element, so that each wrapper is parsed once
    marks = F.array_join(
        F.transform(in_array, lambda x: F.when(x.isNull(), F.lit("-")).otherwise(F.lit("+"))), "")
    return F.when(at_once, F.lit(True)).otherwise(
        F.coalesce((marks == "+") & as_member["w"].isNotNull(), F.lit(False)))


def is_object_text(nested: Column) -> Column:
    """Does the raw text of a nested field hold an object?  Null gives False."""
    return F.coalesce(nested.rlike(r"^\s*\{"), F.lit(False))


def json_field(obj: Column, name: str) -> Column:
    """One field of an object held as text, as text (nested values keep their JSON)."""
    return F.from_json(obj, f"`{name}` string")[name]


# Spark's JSON functions write numbers anew (1.10 as 1.1, 1e400 as "Infinity").  Where a text
# is sent on, its numbers are turned into marked strings first and back at the end.
_STRING_OR_NUMBER = r"""("(?:[^"\\]|\\.)*+"|'(?:[^'\\]|\\.)*+')|(-?[0-9][0-9.eE+-]*+)"""


def keep_numbers(text: Column) -> Column:
    """Every number of a JSON text as a marked string; strings are stepped over whole."""
    fenced = F.regexp_replace(text, _STRING_OR_NUMBER, "$1\u0001$2\u0001")
    return F.regexp_replace(F.replace(fenced, F.lit("\u0001\u0001"), F.lit("")),
                            "\u0001([^\u0001]*)\u0001", f'"{_MARK}$1"')


def restore_numbers(text: Column) -> Column:
    """Undo ``keep_numbers``: the numbers as they were spelled."""
    return F.regexp_replace(text, f'"{_MARK}([^"]*)"', "$1")


def json_value(c: Column) -> Column:
    """A plain value (string, number, ...) as JSON text; null stays null."""
    listed = F.to_json(F.array(c))
    return F.when(c.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def json_string(c: Column) -> Column:
    """``json_value`` of a string; one without quotes, escapes and control characters is not parsed."""
    return F.when(c.rlike(r'["\\\x00-\x1f]'), json_value(c)).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` names it; inside
    the lambda functions of others a plain column is evaluated anew for every element."""
    return F.transform(F.array(value), body)[0]


def json_put(obj: Column, members: dict[str, Column]) -> Column:
    """Set members (as JSON text) on an object held as text, replacing equal names.

    Of repeated names the last counts; null members are left out.
    """
    names = list(members)

    def kept(texts: Column, kinds: Column, keys: Column) -> Column:
        listed = F.arrays_zip(keys.alias("k"), F.map_values(texts).alias("t"), F.map_values(kinds).alias("v"))
        return F.filter(listed, lambda m, i: ~m["k"].isin(*names) & ~F.is_variant_null(m["v"])
                        & ~F.array_contains(F.slice(keys, i + F.lit(2), F.size(keys)), m["k"]))

    def written(m: Column) -> Column:
        return F.concat(json_value(m["k"]), F.lit(":"),
                        F.when(F.schema_of_variant(m["v"]) == "STRING", json_value(m["t"])).otherwise(m["t"]))

    # strings without quotes, all else as JSON
    old = _let(obj, lambda o: _let(F.from_json(o, "map<string,string>"), lambda texts: _let(
        F.map_keys(texts), lambda keys: F.transform(
            kept(texts, F.from_json(o, "map<string,variant>"), keys), written))))
    new = [F.when(members[n].isNotNull(), F.concat(json_value(F.lit(n)), F.lit(":"), members[n])) for n in names]
    return F.concat(F.lit("{"), F.concat_ws(",", old, *new), F.lit("}"))


# An object without white space whose members are strings without escapes, numbers or booleans.
_PLAIN_OBJECT = (r'(\{(?:"[^"\\\x00-\x1f]*+":(?:"[^"\\\x00-\x1f]*+"|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?'
                 r'|true|false)(?:,(?=")|(?=\})))++\})')


def plain_member_put(text: Column, name: str, members: dict[str, Column]) -> Column:
    """What ``json_put`` makes of the object ``name`` of an object held as text, numbers as they
    are spelled; null where that takes a parse.

    The member is cut out of the text as it stands.  That is certain where its name stands there
    once, no escape or other quote can spell it otherwise, and it holds no null, no repeated name
    and none of ``members``.
    """
    quoted = F.lit(f'"{name}"')
    again = F.call_function("locate", quoted, text, F.call_function("locate", quoted, text) + F.lit(1))
    certain = ~F.contains(text, F.lit("\\")) & ~F.contains(text, F.lit("'")) & (again == 0)
    new = [F.when(m.isNotNull(), F.concat(F.lit(","), json_value(F.lit(n)), F.lit(":"), m)) for n, m in members.items()]

    def put(found: Column) -> Column:
        fits = _let(F.json_object_keys(found), lambda keys: (F.size(F.array_distinct(keys)) == F.size(keys))
                    & ~F.arrays_overlap(keys, F.array(*[F.lit(n) for n in members])))
        return F.when((found != "") & fits, F.concat(
            F.substring(found, F.lit(1), F.length(found) - 1), F.concat_ws("", *new), F.lit("}")))

    return F.when(certain, _let(F.regexp_extract(text, f'"{name}":{_PLAIN_OBJECT}', 1), put))
