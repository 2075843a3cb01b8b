"""State and tables that move on batch by batch, lateness and handover, against brute force."""

import datetime
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillhouse.feeds import derive
from rillhouse.functions import keep_numbers, restore_numbers
from rillhouse.operators import changes, dims, handover, lateness, windows
from rillhouse.plans import ads
from rillhouse.sources.schemas import window_schema
from rillhouse.streaming import jobs, window_state
from rillhouse.streaming.batch_store import BatchStore

DAY = datetime.datetime(2024, 1, 1)


# ------------------------------------------------------------------ the store

def put(store, batch, rows, days=None):
    turn = store.begin(batch)
    if turn is not None:
        turn.append("t", store.spark.createDataFrame(rows, "d date, v int"), by="d")
        turn.commit()


def values(frame):
    return sorted(r.v for r in frame.collect())


def test_readers_see_whole_batches_and_keep_their_files(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    assert store.begin(0) is not None and store.days("t") == [] and store.table("t", "d date, v int").count() == 0
    put(store, 0, [(DAY.date(), 1)])
    early = store.table("t", "d date, v int")
    put(store, 1, [(DAY.date(), 2), (DAY.date() + datetime.timedelta(1), 3)])
    put(store, 1, [(DAY.date(), 9)])                       # the batch runs again
    assert values(early) == [1] and values(store.table("t", "d date, v int")) == [1, 2, 3]
    assert store.days("t") == ["2024-01-01", "2024-01-02"]
    assert values(store.table("t", "d date, v int", ["2024-01-02"])) == [3]


def test_compaction_adds_nothing(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    for batch in range(6):
        put(store, batch, [(DAY.date(), batch), (DAY.date() + datetime.timedelta(batch % 2), 10 + batch)])
    before = values(store.table("t", "d date, v int"))
    open_reader = store.table("t", "d date, v int", ["2024-01-01"])
    files = len(open_reader.inputFiles())
    assert store.compact("t", "d date, v int", "2024-01-01")
    folded = store.table("t", "d date, v int", ["2024-01-01"])
    assert len(folded.inputFiles()) == 1 < files
    assert values(open_reader) == values(folded) and values(store.table("t", "d date, v int")) == before
    put(store, 5, [(DAY.date(), 5)])                       # a repeated batch after the swap
    put(store, 6, [(DAY.date(), 6)])
    assert values(store.table("t", "d date, v int")) == sorted([*before, 6])
    assert not store.compact("t", "d date, v int", "2024-01-07")


def test_writers_that_meet_do_not_overwrite(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    first, second = store.begin(0), BatchStore(spark, str(tmp_path / "s")).begin(0)
    first.append("t", spark.createDataFrame([(DAY.date(), 1)], "d date, v int"), by="d")
    second.append("t", spark.createDataFrame([(DAY.date(), 2)], "d date, v int"), by="d")
    first.commit()
    with pytest.raises(RuntimeError):
        second.commit()
    assert values(store.table("t", "d date, v int")) == [1]


def test_report_lists_one_of_many_days(spark, tmp_path):
    table = "dws_traffic_page_view_window"
    store = BatchStore(spark, str(tmp_path / "s"))
    rows = spark.range(400).selectExpr(
        "timestamp'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS stt",
        "timestamp'2024-01-01 00:00:30' + make_dt_interval(CAST(id AS INT)) AS edt",
        "date_add(date'2024-01-01', CAST(id AS INT)) AS cur_date", "id AS pv_ct", "1L AS uv_ct", "1L AS sv_ct", "0L AS ts")
    turn = store.begin(0)
    turn.append(table, rows.coalesce(2), by="cur_date")
    turn.commit()
    newest = store.table(table, window_schema(table), store.days(table)[-1:])
    assert len(store.days(table)) == 400 and len(newest.inputFiles()) == 1
    assert [(str(r.cur_date), r.pv_ct) for r in ads.traffic_stats_today(newest).collect()] == [("2025-02-03", 399)]


def test_old_folders_are_removed(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"))
    for batch in range(5):
        turn = store.begin(batch)
        rows = spark.createDataFrame([(batch % 2, "k", batch)], "bucket int, key string, at bigint")
        turn.put_state("x", rows, [batch % 2], F.min("at"))
        turn.commit()
    held = sorted(p.name for p in (tmp_path / "s" / "state" / "x").iterdir())
    assert len(held) == 3 and [r.at for r in store.state("x", "key string, at bigint").orderBy("at").collect()] == [3, 4]
    assert len(list((tmp_path / "s" / "commits").glob("[0-9]*.json"))) == 2


# ------------------------------------------------------------------ windows in one pass

VIEW = '{"common":{"mid":"%s","sid":"s%d"},"page":{"page_id":"p"},"ts":%d}'


def view_rows(spark, events):
    from rillhouse.operators import logs

    rows = spark.createDataFrame(
        [(VIEW % (mid, s % 3, (1704067200 + s) * 1000) if s is not None else '{"common":{"mid":"m"},"page":{},"ts":9223372036854775807}',
          DAY, str(i)) for i, (mid, s) in enumerate(events)], "value string, arrival_ts timestamp, seq string")
    return logs.log_stream(logs.split_logs(rows), "page").drop("item")


def test_window_outputs_of_one_pass(spark, tmp_path):
    """Closed windows, rejected and late rows; a repeated batch changes nothing."""
    kind = window_state.traffic()
    store = BatchStore(spark, str(tmp_path / "w"))
    write = window_state.window_batches(store, kind, buckets=3)

    def closed():
        return sorted((r.stt.second + 60 * r.stt.minute, r.pv_ct, r.uv_ct, r.sv_ct)
                      for r in store.table(kind.table, window_schema(kind.table)).collect())

    write(view_rows(spark, [("a", 1), ("b", 29), ("a", 28), ("c", 34), ("x", None)]), 0)
    assert closed() == [(0, 3, 2, 2)]
    for _ in range(2):
        write(view_rows(spark, [("a", 5), ("c", 40), ("d", 70)]), 1)    # second 5 is late
    assert closed() == [(0, 3, 2, 2), (30, 2, 1, 1)]
    write(view_rows(spark, [("e", 58), ("d", 72), ("f", 200)]), 2)
    assert closed() == [(0, 3, 2, 2), (30, 2, 1, 1), (60, 2, 1, 2)]
    late = store.table(window_state.LATE, window_state.LATE_TABLE).collect()
    assert sorted(r.event_ts.second + 60 * r.event_ts.minute for r in late) == [5, 58]
    assert store.table("dirty", "stage string, value string, reason string, arrival_ts timestamp").count() == 1
    assert sum(b["rows"] for b in store.last()["state"]["open"]["buckets"].values()) == 2   # f, its session


def test_order_windows_equal_the_batch_form(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"s{rng.randrange(3)}", f"o{i}", rng.choice(["", "name", " ", "other"]), rng.choice(["1.005", "9e13", "2", "x"]),
             str(rng.randrange(4)), str(DAY + datetime.timedelta(seconds=i)), i, f"{i:04d}") for i in range(300)]
    schema = ("sku_id string, order_id string, sku_name string, split_total_amount string, sku_num string, "
              "create_time string, _join_ts bigint, id string")
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "id AS value", "timestamp'2024-01-01' AS arrival_ts")
    kind = window_state.sku("event")
    store = BatchStore(spark, str(tmp_path / "w"))
    write = window_state.window_batches(store, kind, buckets=2)
    for batch, (a, b) in enumerate(((0, 100), (100, 117), (117, 300))):
        write(frame.filter(f"_join_ts >= {a} AND _join_ts < {b}"), batch)
    want = windows.sku_windows(windows.parse_sku_facts(frame)).filter("edt <= timestamp'2024-01-01 00:04:56'").drop("ts")
    got = store.table(kind.table, window_schema(kind.table)).drop("ts").select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.filter("sku_name IS NOT NULL").count() > 5


# ------------------------------------------------------------------ dimensions

def test_dimension_state_like_folding_the_whole_log(spark, tmp_path):
    """Batches in any order; a reader between batches sees one version."""
    t = derive.Tables(spark, "/root/testdata/sf0.001")
    text = derive.dim_text(t).withColumn("route", F.lit("ods_db"))
    config = derive.config_text(spark).withColumn("route", F.lit(jobs.CONFIG_ROUTE))
    periods = dims.config_periods(dims.read_config(config))

    def folded(rows):
        log = dims.cell_log(dims.project_dims(dims.with_config(dims.read_dim_changes(rows), periods)))
        return sorted(map(repr, dims.fold_cells(log).select(*dims.CELL, "cell").collect()))

    store = BatchStore(spark, str(tmp_path / "d"))
    write = jobs.dim_batches(store, buckets=4)
    write(config, 0)
    late, early = text.filter("seq >= '3'"), text.filter("seq < '3'")
    write(late, 1)
    reader = jobs.current_cells(store)
    write(early, 2)
    write(early, 2)
    assert sorted(map(repr, reader.select(*dims.CELL, "cell").collect())) == folded(late)
    assert sorted(map(repr, jobs.current_cells(store).select(*dims.CELL, "cell").collect())) == folded(text)


def test_new_configuration_creates_its_target(spark, tmp_path):
    config = derive.config_text(spark).withColumn("route", F.lit(jobs.CONFIG_ROUTE))
    store = BatchStore(spark, str(tmp_path / "d"))
    write = jobs.dim_batches(store, database="dim_state_test")

    def targets():
        return {r.tableName for r in spark.sql("SHOW TABLES IN dim_state_test").collect()}

    first = F.get_json_object("value", "$.after.sink_table") != "dim_base_province"
    write(config.filter(first), 0)
    assert targets() == {"dim_user_info", "dim_sku_info"}
    write(config.filter(F.coalesce(~first, F.lit(True))), 1)
    assert targets() == {"dim_user_info", "dim_sku_info", "dim_base_province"}
    spark.sql("DROP DATABASE dim_state_test CASCADE")


# ------------------------------------------------------------------ lateness and handover

def test_lateness_row_by_row(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(0, 900), rng.randrange(0, 1000)) for i in range(500)]
    made = spark.createDataFrame(rows, "seq int, arr int, sec int").repartition(6).selectExpr(
        "seq", "arr", "timestamp_seconds(1704067200 + sec) AS event_ts", "CAST(NULL AS STRING) AS reason")
    got = {r.seq: (r.late, r.watermark and int(r.watermark.timestamp())) for r in
           lateness.with_lateness(made, ["arr", "seq"]).collect()}
    latest = None
    for seq, _, sec in sorted(rows, key=lambda r: (r[1], r[0])):
        late = latest is not None and sec // 30 * 30 + 30 <= latest - 3
        assert got[seq] == (late, None if latest is None else 1704067200 + latest - 3)
        latest = sec if latest is None else max(latest, sec)
    assert lateness.with_lateness(made.limit(0), ["arr", "seq"]).count() == 0


def test_stitched_history_like_one_key_at_a_time(spark):
    rng = random.Random(5)
    chunks = [(c, low, low + 30) for c, low in ((0, 20), (1, 45), (2, 10))]
    changes_, seen = [], []
    for key in range(30):
        state, read = None, chunks[key // 10][1] + rng.randrange(31)
        for position in sorted(rng.sample(range(100), rng.randrange(6))):
            op = rng.choice("cud")
            changes_.append((key, op, position, f"{key}@{position}"))
            if position <= read:
                state = None if op == "d" else f"{key}@{position}"
        if state is not None:
            seen.append((key, state))
    late_key = [(77, "c", 5, "no chunk")]
    want = []
    for key in range(30):
        high = chunks[key // 10][2]
        before = [c for c in changes_ if c[0] == key and c[2] <= high]
        if before and before[-1][1] != "d":
            want.append((key, "r", high, before[-1][3]))
        want += [c for c in changes_ if c[0] == key and c[2] > high]
    got = handover.stitched(
        spark.createDataFrame(seen, "key int, value string"), spark.createDataFrame(chunks, "chunk int, low int, high int"),
        spark.createDataFrame(changes_ + late_key, "key int, op string, position int, value string"),
        F.expr("key DIV 10").cast("int"))
    assert sorted(map(tuple, got.collect())) == sorted(want + late_key)


# ------------------------------------------------------------------ text that is sent on

SCALAR = st.one_of(st.none(), st.booleans(), st.integers(), st.text(max_size=12),
                   st.sampled_from(["7 12", "\ue000\ue0017", "\ue0001", "it's", 'say "1"', "\\", "\u0001 5", "\n"]))
DOCUMENT = st.dictionaries(st.text(min_size=1, max_size=5).filter(lambda k: k not in ("id", "n")), st.recursive(
    SCALAR, lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.text(max_size=4), x, max_size=3)), max_leaves=6), max_size=5)


@settings(max_examples=25, deadline=None)
@given(st.lists(DOCUMENT, min_size=5, max_size=12))
def test_any_text_is_sent_on_unchanged(spark, documents):
    """Members come back as they were: numbers by spelling, strings by value."""
    from rillhouse.functions import json_put, json_value

    texts = [json.dumps(d, ensure_ascii=i % 2 == 0)[:-1] + (", " if d else "") + '"n": 1.10, "id": "x"}' for i, d in enumerate(documents)]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    put_ = restore_numbers(json_put(keep_numbers(F.col("value")), {"id": json_value(F.lit("new"))}))
    for document, row in zip(documents, rows.select(put_.alias("v")).collect()):
        back = json.loads(row.v)
        want = {k: v for k, v in document.items() if v is not None} | {"n": 1.10, "id": "new"}
        assert back == want and '"n":1.10' in row.v


def test_single_quotes_and_marks_stay_json(spark):
    texts = [("{'id':'7 12','n':1.50,'s':'a\"b'}", {"id": "7 12", "n": 1.5, "s": 'a"b'}),
             ('{"id":"1","n":"\ue000\ue001abc","m":1e400}', {"id": "1", "n": "\ue000\ue001abc", "m": float("inf")})]
    rows = spark.createDataFrame([(t,) for t, _ in texts], "value string")
    from rillhouse.functions import json_put, json_value

    put_ = restore_numbers(json_put(keep_numbers(F.col("value")), {"x": json_value(F.lit("y"))}))
    for (_, want), row in zip(texts, rows.select(put_.alias("v")).collect()):
        assert json.loads(row.v) == want | {"x": "y"}
    event = "{'op':'c','source':{'table':'favor_info'},'after':{'id':'7 12','user_id':1.10}}"
    sent = changes.detail_text(changes.split_changes(spark.createDataFrame(
        [(event, DAY, "")], "value string, arrival_ts timestamp, seq string"))).first().value
    assert json.loads(sent)["id"] == "7 12" and '"user_id":1.10' in sent


# ------------------------------------------------------------------ bucketed tables

def test_totals_of_a_bucketed_table_need_no_exchange(spark, tmp_path):
    from rillhouse.plans import tables

    tables.create_window_tables(spark, "bucketed_test", buckets=4, location=str(tmp_path / "db"))
    rows = spark.range(200).selectExpr(
        "concat('s', id % 7) AS sku_id", "timestamp'2024-01-01' + make_dt_interval(CAST(id % 3 AS INT)) AS stt",
        "timestamp'2024-01-01 00:00:30' AS edt", "'n' AS sku_name", "date_add(date'2024-01-01', CAST(id % 3 AS INT)) AS cur_date",
        "CAST(id AS DECIMAL(16,2)) AS order_amount", "1L AS order_count", "id AS sku_num", "0L AS ts")
    tables.insert_windows(rows, "bucketed_test", "dws_trade_sku_order_window")
    totals = tables.daily_totals(spark, "bucketed_test", "dws_trade_sku_order_window")
    got = {(str(r.cur_date), r.sku_id): (int(r.order_amount), r.order_count) for r in totals.collect()}
    want = {}
    for i in range(200):
        key = (str((DAY + datetime.timedelta(i % 3)).date()), f"s{i % 7}")
        amount, count = want.get(key, (0, 0))
        want[key] = amount + i, count + 1
    assert got == want
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP DATABASE bucketed_test CASCADE")
