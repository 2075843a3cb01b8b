import pytest
from pyspark.sql import functions as F

from rillhouse.feeds import derive
from rillhouse.functions import millis_to_timestamp
from rillhouse.operators import facts, logs, replay, windows
from rillhouse.sources.schemas import FACT_FIELDS

SF = "/root/testdata/sf0.001"
T0 = 1704067200


def rows(spark, fields, data):
    """Each row: (second, {field: value}); missing fields are null."""
    schema = "s int, " + ", ".join(f"{f} string" for f in fields)
    made = spark.createDataFrame([(s, *[v.get(f) for f in fields]) for s, v in data], schema)
    return made.select(*fields, F.timestamp_seconds(F.lit(T0) + F.col("s")).alias("arrival_ts"),
                       F.lit("").alias("seq"))


def detail(i, **more):
    return {"id": str(i), "order_id": "o", "sku_id": "s", "sku_num": "1",
            "split_total_amount": "2.5", **more}


def inputs(spark, d, o, a=(), c=()):
    return (rows(spark, facts.DETAIL_FIELDS, d), rows(spark, facts.ORDER_FIELDS, o),
            rows(spark, facts.ACTIVITY_FIELDS, a), rows(spark, facts.COUPON_FIELDS, c))


def test_input_checks(spark):
    cases = [(detail(1), None), (detail(1, order_id=" "), "missing key"),
             (detail(1, sku_num="12.7"), "bad sku_num"), (detail(1, sku_num=None), "bad sku_num"),
             (detail(1, split_total_amount="abc"), "bad amount"),
             (detail(1, split_coupon_amount=" "), None)]
    made = rows(spark, facts.DETAIL_FIELDS, [(0, c[0]) for c in cases]).coalesce(1)
    assert [r.reason for r in facts.check_details(made).collect()] == [c[1] for c in cases]


def test_settled_keeps_every_detail_and_newest_versions(spark):
    d, o, a, c = inputs(
        spark, [(1, detail(1)), (2, detail(2, split_total_amount="")), (9, detail(1, sku_num="7"))],
        [(3, {"id": "o", "user_id": "u1"}), (5, {"id": "o", "user_id": "u2"})],
        [(4, {"order_detail_id": "1", "activity_id": "a1"})])
    got = {r.id: r for r in facts.settle(d, o, a, c).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"].sku_num, got["1"].user_id, got["1"].activity_id) == ("7", "u2", "a1")
    assert (got["2"].split_total_amount, got["2"].activity_id) == ("0", None)
    assert got["1"]._join_ts == (T0 + 9) * 1000


@pytest.mark.parametrize("slice_seconds", [1, 7, 60, 10_000])
def test_changelog_state(spark, slice_seconds):
    d, o, a, c = inputs(
        spark, [(0, detail(1)), (10, detail(2)), (2000, detail(3))],
        [(20, {"id": "o", "user_id": "u1"})],
        [(30, {"order_detail_id": "2", "activity_id": "a"})])
    got = replay.fact_changelog(d, o, a, c, slice_seconds=slice_seconds)
    # one detail per order is kept: 1 is lost; 2 is emitted again for its activity;
    # at 2000 the order (written at 20) has expired
    assert sorted((r.id, r._join_ts // 1000 - T0, r.activity_id) for r in got.collect()) == [
        ("2", 20, None), ("2", 30, "a")]


@pytest.mark.parametrize("age, emitted", [(1799, 1), (1800, 0)])
def test_state_expires_at_thirty_minutes(spark, age, emitted):
    d, o, _, _ = inputs(spark, [(age, detail(1))], [(0, {"id": "o"})])
    assert replay.base_changelog(d, o).count() == emitted


def brute_changelog(events, alone, ttl=1_800_000):
    """Newest row per key and side, row by row: (key, at, seq, l, r)."""
    out, known = [], {}
    for key, side, at, seq in sorted(events, key=lambda e: (e[2], e[1], e[3])):
        state = known.setdefault(key, {})
        state[side] = (at, seq)
        l, r = (state.get(i) for i in (0, 1))
        l_ok, r_ok = (x is not None and at - x[0] < ttl for x in (l, r))
        if l_ok and (r_ok or alone):
            out.append((key, at, f"{side}|{seq}", l[1], r[1] if r_ok else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("alone", [True, False])
def test_slices_give_the_changelog_row_by_row(spark, alone):
    """One key with nine tenths of all rows; its timeline is shared by several tasks."""
    hot = spark.range(900).select(
        F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"),
        (F.col("id") % 7 % 2).cast("int").alias("side"), (F.col("id") * 7919 % 9000 * 1000).alias("at"),
        F.format_string("%04d", "id").alias("seq"),
        F.struct(F.format_string("%04d", "id").alias("x")).alias("payload"))
    sides = [hot.filter(F.col("side") == i) for i in (0, 1)]
    want = brute_changelog([tuple(r)[:4] for r in hot.collect()], alone)
    for slice_seconds in (7, 60, 1800):
        got = replay.keyed_changelog(*sides, emit_alone=alone, slice_seconds=slice_seconds)
        assert sorted(((r.key, r.at, r.seq, r.l.x, r.r and r.r.x) for r in got.collect()), key=repr) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = replay.keyed_changelog(*sides, emit_alone=alone)
        assert got.filter("key = 'hot'").select(F.spark_partition_id()).distinct().count() > 2
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_COL") >= 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_changelog_sends_its_inputs_through_one_shuffle(spark):
    """Every join evaluated its inputs twice, so the last one did eight times."""
    d, o, a, c = inputs(spark, [(0, detail(1))], [(0, {"id": "o"})],
                        [(0, {"order_detail_id": "1"})], [(0, {"order_detail_id": "1"})])
    plan = replay.fact_changelog(d, o, a, c)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Join" not in plan


def test_no_value_stops_a_window(spark):
    """Values no table or timestamp can hold are dirty or fall back; other rows stay."""
    most = str(2 ** 63 - 1)
    facts_in = [("1", "1e15", "1", "2024-01-01 00:00:01"), ("2", "-1e30", "1", "2024-01-01 00:00:01"),
                ("3", "1", most, "2024-01-01 00:00:01"), ("4", "1.005", "1", "2024-01-01 00:00:01"),
                ("5", "2", "1", most), ("6", "99999999999999.99", "1", "2024-01-01 00:01:01"),
                ("7", "99999999999999.99", "1", "2024-01-01 00:01:01"), ("8", "0.0049999999", "2", "2024-01-01 00:02:01")]
    made = spark.createDataFrame(facts_in, "id string, split_total_amount string, sku_num string, create_time string")
    made = made.selectExpr("*", "'s' AS sku_id", "'o' AS order_id", "'p' AS province_id", "'n' AS sku_name",
                           "0L AS _join_ts")
    for parse, fold in ((windows.parse_sku_facts, windows.sku_windows),
                        (windows.parse_province_facts, windows.province_windows)):
        parsed = parse(made)
        assert sorted(r.id for r in parsed.filter("reason = 'bad amount'").collect()) == ["1", "2"]
        got = {str(r.stt): r for r in fold(parsed, with_ts=False).filter("stt < '2025-01-01'").collect()}
        first, second, third = (got[f"2024-01-01 00:0{i}:00"] for i in range(3))
        assert (str(first.order_amount), first.sku_num, first.order_count) == ("2.01", None, 2)
        assert (second.order_amount, second.sku_num) == (None, 2)
        assert str(third.order_amount) == "0.00"
    text = spark.createDataFrame([(f'{{"common":{{"mid":"m"}},"page":{{}},"ts":{t}}}',) for t in (most, 1000)],
                                 "value string")
    views = windows.parse_page_views(logs.read_logs(text)).collect()
    assert [r.reason for r in views] == ["bad ts", None]
    assert spark.range(1).select(millis_to_timestamp(F.lit(2 ** 62)).alias("t")).first().t is None


def test_window_aggregates(spark):
    facts_in = [("1", "s", None, "2.345", "1", 5), ("2", "s", "b", "1", "2", 29),
                ("3", "s", "a", "", "3", 10), ("4", "s", "c", "1", "1", 30),
                ("5", "s", "x", "bad", "1", 1)]
    made = spark.createDataFrame(facts_in, "id string, sku_id string, sku_name string, "
                                 "split_total_amount string, sku_num string, t int")
    made = made.select("*", F.lit("o").alias("order_id"), F.lit("p").alias("province_id"),
                       F.date_format(F.timestamp_seconds(F.lit(T0) + F.col("t")),
                                     "yyyy-MM-dd HH:mm:ss").alias("create_time"),
                       F.col("t").cast("bigint").alias("_join_ts"))
    parsed = windows.parse_sku_facts(made)
    assert [r.id for r in parsed.filter("reason is not null").collect()] == ["5"]
    got = windows.sku_windows(parsed, with_ts=False).orderBy("stt").collect()
    assert [(str(r.order_amount), r.order_count, r.sku_num, r.sku_name) for r in got] == [
        ("3.35", 3, 6, "a"), ("1.00", 1, 1, "c")]
    assert windows.province_windows(windows.parse_province_facts(made)).count() == 2


def test_feed_covers_every_fact_field(spark):
    t = derive.Tables(spark, SF)
    fact = facts.settle(*facts.clean_inputs(derive.details(t), derive.orders(t),
                                            derive.activities(t), derive.coupons(t)))
    filled = fact.select(*[F.count(n).alias(n) for n in FACT_FIELDS]).first().asDict()
    assert all(filled.values())


def test_versions_are_not_sorted_before_their_shuffle(spark):
    """Reducing nearly unique ids in front of the shuffle sorted every split."""
    one = inputs(spark, [(0, detail(1))], [(0, {"id": "o"})])[:2]
    plan = facts.settle(*one)._jdf.queryExecution().executedPlan().toString().splitlines()
    for at, line in enumerate(plan):
        if "REPARTITION_BY_COL" in line:
            assert not any("SortAggregate" in below for below in plan[at:at + 3])
    assert sum("REPARTITION_BY_COL" in line for line in plan) == 2


def test_part_join_of_the_feed_shuffles_no_text_of_the_line(spark):
    """``seq`` went through the shuffles of the join to the parts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = derive.details(derive.Tables(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = plan[plan.index("Exchange hashpartitioning(l_partkey"):]
    assert "concat_ws" not in shuffled and "concat_ws" in plan


def test_settled_join_can_split_a_hot_order(spark):
    """Both sides of the order join come straight from a shuffle, details share one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = inputs(spark, [(0, detail(i)) for i in range(50)], [(0, {"id": "o"})],
                     [(0, {"order_detail_id": "1"})], [(0, {"order_detail_id": "1"})])
        fact = facts.settle(*one)
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 6  # four inputs, two for the order join
    assert fact.count() == 50
