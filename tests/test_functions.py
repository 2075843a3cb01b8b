from pyspark.sql import functions as F

from rillhouse import functions as fn

OBJECTS = ['{"a":1}', '{}', "{'a':1}", '{"a":1,"a":2}', ' {"a":[{"b":"x]"}]} ']
NO_OBJECTS = ['[1]', '"x"', '1', 'null', '{"a":1} xx', '{"a":1}{"b":2}', '{"a":1},{"b":2}',
              '{"a":1}],[{"b":1}', '{"a":', '{"a":1},"z":{}', '', '   ', '\t', None]


def column(spark, values, expression):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in rows.select(expression(F.col("v"))).collect()]


def test_json_object_gate(spark):
    assert all(column(spark, OBJECTS, fn.is_json_object))
    assert not any(column(spark, NO_OBJECTS, fn.is_json_object))


def test_integers(spark):
    texts = ["12", " 12 ", "+12", "12.7", "1e3", "abc", "9223372036854775808", "", None]
    assert column(spark, texts, fn.parse_integer) == [12, None, 12] + [None] * 6


def test_amounts(spark):
    good = ["12", "+12", "12.7", "1e3", ".5", "5.", "", None, " "]
    bad = [" 12 ", "abc", "NaN", "1d", "0x1F", "."]
    assert all(column(spark, good, fn.is_valid_amount))
    assert not any(column(spark, bad, fn.is_valid_amount))
    values = column(spark, good, fn.parse_amount)
    assert [float(v) for v in values] == [12, 12, 12.7, 1000, 0.5, 5, 0, 0, 0]
    assert column(spark, bad, fn.parse_amount) == [None] * len(bad)
    assert column(spark, ["", " ", None, "1.0"], fn.amount_or_zero) == ["0", "0", "0", "1.0"]


def test_rounding_is_half_up(spark):
    rounded = column(spark, ["2.345", "-2.345", "2.344"],
                     lambda c: fn.round_money(fn.parse_amount(c)))
    assert [str(v) for v in rounded] == ["2.35", "-2.35", "2.34"]


def test_blank_and_defaults(spark):
    assert column(spark, [None, "", " \t\n", "\x00", "a", " "], fn.is_blank) == [
        True, True, True, True, False, False]
    assert column(spark, [None, " ", "\tx "], lambda c: fn.default_if_blank(c, "d")) == ["d", "d", "x"]
    assert column(spark, ["a, b,,c ", " ", None], fn.split_and_trim) == [["a", "b", "c"], None, None]
    assert column(spark, ["DIM", "dim", "x", None], lambda c: fn.equals_ignore_case(c, "dim")) == [
        True, True, False, False]


def test_tsv(spark):
    lines = column(spark, ["a\tb\r\nc", None], lambda c: fn.tsv_line(c, F.lit("z")))
    assert lines == ["a b  c\tz", "\tz"]


def test_event_time(spark):
    fallback = F.lit("2020-02-02 00:00:00").cast("timestamp")
    got = column(spark, ["1704067200000", "2024-01-01 10:20:30", "x", "", None],
                 lambda c: fn.second_label(fn.parse_event_time(c, fallback)))
    assert got == ["2024-01-01 00:00:00", "2024-01-01 10:20:30"] + ["2020-02-02 00:00:00"] * 3


def test_json_put_replaces_and_drops_nulls(spark):
    got = column(spark, ['{"a":1,"ts":5,"n":null,"a":2}', '{}'],
                 lambda c: fn.json_put(c, {"ts": fn.json_value(F.lit(7)), "t": fn.json_value(F.lit('x"y')),
                                           "gone": fn.json_value(F.lit(None).cast("string"))}))
    assert got == ['{"a":2,"ts":7,"t":"x\\"y"}', '{"ts":7,"t":"x\\"y"}']


def test_json_put_keeps_the_spelling(spark):
    text = ('{"n":12345678901234567890123456789012345678901234567890,"e":1e400,"d":1.10,"s":"1.10 , 2","q":"a\\"b\\u00e9",'
            '"o":{"x":1.50,"y":null},"l":[1.0,"2"],"b":true}')
    got = column(spark, [text], lambda c: fn.restore_numbers(
        fn.json_put(fn.keep_numbers(c), {"_op": fn.json_value(F.lit("u"))})))
    assert got == [text[:-1].replace("\\u00e9", "é") + ',"_op":"u"}']


def test_json_put_reads_its_object_once(spark):
    """the object's expression was evaluated again for every member of it."""
    text = '{"a":1.0,"b":"x","a":"y","c":null,"d":[1,"2"],"op":"old"}'
    rows = spark.createDataFrame([(text,), (None,)], "value string")
    put = fn.json_put(F.trim("value"), {"op": F.lit('"c"'), "none": F.lit(None).cast("string")}).alias("x")
    assert [r.x for r in rows.select(put).collect()] == ['{"b":"x","a":"y","d":[1,"2"],"op":"c"}', '{"op":"c"}']
    plan = rows.select(put)._jdf.queryExecution().analyzed().toString()
    assert plan.count("trim(") == 1
