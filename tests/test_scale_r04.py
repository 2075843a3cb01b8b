"""Findings of round 4: the work stays whole, rows and results are as before."""

from __future__ import annotations

from pyspark.sql import functions as F
from rillhouse import functions as fn


def test_plain_member_is_cut_out_as_json_put_makes_it(spark):
    """every event was marked, parsed and written anew, member by member."""
    plain = ['{"op":"c","after":{"id":"1","n":1.10,"big":123456789012345678901234567890,"e":-0.5e400,"b":true,"s":"x} é,"}}',
             '{"after":{"id":""},"before":{"id":2}}']
    other = ['{"after":{"id":"1","id":"2"}}', '{"after":{"id":"1","_op":"old"}}', '{"after":{"id":"1","x":null}}',
             '{"after":{"id":"a\\"b"}}', "{'after':{'id':'1'}}", '{"after":{"id":"1","o":{"x":1.50}}}',
             '{"after": {"id":"1"}}', '{"before":{"after":{"id":"0"}},"after":{"id":"1"}}', '{"after":{"n":NaN}}',
             '{"after":{"n":01}}', '{"aft\\u0065r":{"id":"1"},"x":{"after":{"id":"2"}}}', '{"after":{}}', '{"op":"c"}', None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(plain + other)], "i int, value string")
    members = {"_op": fn.json_string(F.lit("u")), "_q": fn.json_string(F.lit('a"b')), "_none": F.lit(None).cast("string")}
    parsed = fn.restore_numbers(fn.json_put(fn.json_field(fn.keep_numbers(F.col("value")), "after"), members))
    found = rows.select("i", fn.plain_member_put(F.col("value"), "after", members).alias("cut"), parsed.alias("parsed"))
    for row in found.collect():
        assert row.cut == (row.parsed if row.i < len(plain) else None)
    many = '{"after":{' + ",".join(f'"m{i}":"{i}"' for i in range(20_000)) + "}}"
    cut = spark.createDataFrame([(many,)], "value string").select(fn.plain_member_put(F.col("value"), "after", members))
    assert cut.first()[0] == many[9:-2] + ',"_op":"u","_q":"a\\"b"}'


def test_replay_sends_a_row_to_a_second_slice_near_its_end_only(spark):
    """every row of every join went to two slices."""
    from rillhouse.operators import replay

    kind, ttl = "key string, side int, at bigint, seq string, payload struct<v: string>", replay.TTL_SECONDS * 1000
    times = [0, 1, ttl, 2 * ttl, 3 * ttl, 3 * ttl + 1, 4 * ttl - 1, 4 * ttl]
    sides = [spark.createDataFrame([("k", i, t, f"{i}", (f"{i}-{t}",)) for t in times], kind) for i in (0, 1)]
    short, long = (replay.keyed_changelog(*sides, emit_alone=False, slice_seconds=n)
                   for n in (replay.SLICE_SECONDS, replay.REPLAY_SECONDS))
    assert sorted(map(repr, short.collect())) == sorted(map(repr, long.collect())) and long.count()
    assert moved(short) == 2 * (len(times) + 3) and moved(long) == 2 * (len(times) + 2)


def moved(rows) -> int:
    """Rows behind the generator that deals them to slices."""
    plan = rows._jdf.queryExecution().analyzed()
    while plan.nodeName() != "Generate":
        plan = plan.children().apply(0)
    return rows.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(rows.sparkSession._jsparkSession, plan).count()


def test_changelog_makes_only_the_columns_asked_for(spark):
    """the province windows read four columns of a changelog fact."""
    from rillhouse.feeds import derive
    from rillhouse.operators import facts, replay

    t = derive.Tables(spark, "/root/testdata/sf0.001")
    inputs = facts.clean_inputs(derive.details(t), derive.orders(t), derive.activities(t), derive.coupons(t))
    columns = ["province_id", "split_total_amount"]
    some, whole = replay.fact_changelog(*inputs, columns=columns), replay.fact_changelog(*inputs)
    assert some.columns == ["id", "split_total_amount", "province_id", "_join_ts", "arrival_ts", "seq"]
    assert sorted(map(repr, some.collect())) == sorted(map(repr, whole.select(some.columns).collect()))


def test_fact_in_parts_is_the_settled_fact(spark, tmp_path):
    """All shuffles of the fact took disk at the same time."""
    import os

    from rillhouse.feeds import derive
    from rillhouse.operators import facts
    from rillhouse.plans import pipeline

    t = derive.Tables(spark, "/root/testdata/sf0.001")
    d, o, a, c = facts.clean_inputs(derive.details(t), derive.orders(t), derive.activities(t), derive.coupons(t))
    few = d.limit(2).unionByName(d.limit(0))
    cases = [(d, a, c, None), (d, None, c, None), (d, None, None, None), (d.limit(0), a, c, None), (few.localCheckpoint(), a, c, None),
             *[(d, a, c, columns) for columns in pipeline.READ_BY.values()], (d, a, c, pipeline.CHECKED)]
    for i, (details, activities, coupons, columns) in enumerate(cases):
        path = str(tmp_path / f"fact{i}")
        want = facts.settle(details, o, activities, coupons, columns)
        got = facts.settle_in_parts(details, o, activities, coupons, path, columns)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        left = [f for folder, _, files in os.walk(path) for f in files if "fact-" not in folder and f.endswith(".parquet")]
        assert not left and len([f for f in os.listdir(path) if f.startswith("fact-")]) == facts.PARTS
