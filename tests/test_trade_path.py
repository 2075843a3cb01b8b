"""The trade path parses each text once and carries only what is asked for."""

from __future__ import annotations

import os

import __spark_entry__ as entry
from pyspark.sql import functions as F
from rillhouse.feeds import derive
from rillhouse.functions import is_json_object
from rillhouse.operators import changes, facts, replay
from rillhouse.plans import pipeline
from rillhouse.session import scratch_path
from rillhouse.sources.schemas import FACT_FIELDS

SMALL = "/root/testdata/sf0.001"


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


def same(a, b) -> bool:
    names = sorted(a.columns)
    return sorted(names) == sorted(b.columns) and not (
        a.select(names).exceptAll(b.select(names)).count() or b.select(names).exceptAll(a.select(names)).count())


def test_gate_takes_exactly_one_object(spark):
    good = ['{}', ' {"a":1} ', '{"a":NaN}', "{'a':[1,{}]}", '{"a":1}\n', '\t{"a":"}"}', '{"a":"]"}', '{"a":"é"}']
    bad = ['', ' ', '5', 'null', '"x"', '[]', '[{}]', '{', '{}}', '{} {}', '{},{}', '{}],[{}', '{},"z":{}', '{"a":1},"m"',
           '{}],["', '{"a":"\x01"}', '{"a":1', '{"a"}', '{a:1}', '{}\x00', '{},5],[{}', None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, value string")
    found = {r.i for r in rows.filter(is_json_object(F.col("value"))).collect()}
    assert found == set(range(len(good)))


def test_texts_of_other_tables_are_left_out_before_the_gate(spark):
    texts = ['{"table":"payment_info"}', "{'table':'payment_info'}", '{"table":"payment\\u005finfo"}',
             '{"table":"order_info","after":{"x":"payment_info_id"}}']
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    assert sorted(r.value for r in changes.may_belong(rows, ["payment_info"]).collect()) == sorted(texts[:3])
    plan = plan_of(entry.queries()["dwd_trade_payment_info"](spark, SMALL))
    assert 'Contains(value' in plan and 'payment_info"' in plan


def test_rejected_facts_come_from_one_pass(spark):
    rows = spark.createDataFrame(
        [("1", "s", "o", "p", "1.5", "2"), ("2", " ", "o", None, "1", "1"), ("3", "s", None, "p", "x", "1"),
         ("4", "s", "o", "p", "1", "1.5"), ("4", "s", "o", "p", "1", "1.5")],
        "id string, sku_id string, order_id string, province_id string, split_total_amount string, sku_num string")
    found = pipeline.window_dirty(rows)
    assert "Union" not in plan_of(found)
    assert sorted((r.stage, r.reason, r.id) for r in found.collect()) == [
        ("dws_trade_province", "bad amount", "3"), ("dws_trade_province", "bad sku_num", "4"),
        ("dws_trade_province", "bad sku_num", "4"), ("dws_trade_province", "missing province_id", "2"),
        ("dws_trade_sku", "bad sku_num", "4"), ("dws_trade_sku", "bad sku_num", "4"),
        ("dws_trade_sku", "missing sku_id or order_id", "2"), ("dws_trade_sku", "missing sku_id or order_id", "3")]


def test_dirty_rows_and_inputs_come_from_one_pass(spark):
    text = derive.trade_text(derive.Tables(spark, SMALL))
    dirty, inputs = pipeline.trade_path(text, scratch_path(spark, "path"))
    assert same(dirty, pipeline.dirty_of_trade(text))
    fact = facts.settle(*facts.clean_inputs(*inputs))
    assert same(fact, pipeline.settled_fact(text))


def test_settled_fact_makes_only_the_columns_asked_for(spark):
    t = derive.Tables(spark, SMALL)
    inputs = facts.clean_inputs(derive.details(t), derive.orders(t), derive.activities(t), derive.coupons(t))
    whole = facts.settle(*inputs)
    assert whole.columns == [*FACT_FIELDS, "_fact_type", "_join_ts"]
    for columns in pipeline.READ_BY.values():
        some = facts.settle(*inputs, columns=columns)
        assert same(some, whole.select(columns))
        assert "struct(coupon_id" in plan_of(whole) and "struct(coupon_id" not in plan_of(some)


def test_feed_files_go_when_a_slice_is_worked_off(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("value"), "id")
    feed = entry._Replay(rows, F.col("id"))

    def held(path):
        return [n for n in os.listdir(path.removeprefix("file:")) if n.endswith(".parquet")] if os.path.isdir(path) else []

    for _ in entry._slices([feed]):
        assert held(feed.path)
    assert not held(feed.path) and not held(feed.all)


def test_changelog_sends_rows_only_to_slices_that_emit(spark):
    """Rows in and around the batch's time, at the borders of slices: the emissions stay."""
    second, ttl = 1000, replay.TTL_SECONDS * 1000
    kind = "key string, side int, at bigint, seq string, payload struct<v: string>"

    def side(number, times):
        return spark.createDataFrame([(k, number, t, f"{i}", (f"{number}-{t}",)) for i, t in enumerate(times)
                                      for k in ("a", None)], kind)

    first, last = 2 * ttl - second, 3 * ttl
    left, right = side(0, [first, 2 * ttl, last]), side(1, [first + 1, 2 * ttl + 5, last - 1])
    earlier = side(0, [0, ttl - second, first - 1]), side(1, [5, ttl, ttl + 1, first - second, last + 1])
    for alone in (True, False):
        plain, narrow = (replay.keyed_changelog(left, right, emit_alone=alone, earlier=earlier, **more)
                         for more in ({}, {"arrivals": (first, last)}))
        assert same(plain, narrow) and plain.count()
        assert len(sent(narrow)) < len(sent(plain))


def sent(rows) -> list:
    """Rows behind the generator that deals to slices."""
    plan = rows._jdf.queryExecution().analyzed()
    while "Generate" != plan.nodeName():
        plan = plan.children().apply(0)
    made = rows.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(rows.sparkSession._jsparkSession, plan)
    return list(range(made.count()))
