import json

from pyspark.sql import functions as F

from rillhouse.operators import changes, dims, gate, logs
from rillhouse.sources.schemas import DWD_ROUTES
from rillhouse.streaming import jobs

NOW = "timestamp'2024-01-01 00:00:00'"


def text(spark, values):
    rows = spark.createDataFrame([(v, f"{i:04d}") for i, v in enumerate(values)],
                                 "value string, seq string")
    return rows.withColumn("arrival_ts", F.expr(NOW))


def event(op="c", table="order_info", after={"id": "1"}, **more):
    return json.dumps({"op": op, "source": {"table": table}, "after": after, "ts_ms": 5, **more})


def test_change_verdicts_in_order(spark):
    cases = [
        (event(), "pass", None), (event(op="r"), "pass", None), (event(op="u"), "pass", None),
        (event(op="d", after=None), "delete", None),
        (event(op=" "), "dirty", "no table or op"), (event(op=None), "dirty", "no table or op"),
        (event(op="x"), "dirty", "unknown op"), (event(after=None), "dirty", "no after"),
        (event(after=[1]), "dirty", "after is no object"),
        (event(after={"id": "  "}), "dirty", "no id"), (event(after={}), "dirty", "no id"),
        (event(table="unknown", after={}), "dirty", "no id"),
        (event(table=None, op="d"), "dirty", "no table or op"),
        (json.dumps({"op": "c", "source": {}, "table": "order_info", "after": {"id": 1}}),
         "dirty", "no table or op"),
        (json.dumps({"op": "c", "table": "order_info", "after": {"id": 1}}), "pass", None),
        (json.dumps({"op": "c", "source": 5, "table": "order_info", "after": {"id": 1}}),
         "dirty", "no table or op"),
        (event(ts_ms="soon"), "dirty", "bad ts_ms"),
    ]
    rows = changes.split_changes(text(spark, [c[0] for c in cases])).orderBy("seq").collect()
    assert [(r.verdict, r.reason) for r in rows] == [c[1:] for c in cases]


def test_routes_and_silent_drop(spark):
    tables = list(DWD_ROUTES) + ["user_info"]
    rows = changes.split_changes(text(spark, [event(table=t) for t in tables]))
    assert [r.route for r in rows.orderBy("seq").collect()] == list(DWD_ROUTES.values()) + [None]


def test_detail_text_adds_metadata(spark):
    routed = changes.split_changes(text(spark, [
        event(after={"id": "1", "_op": "old", "amount": 1.5, "note": None}), "{}"]))
    got = {r.route: r.value for r in changes.detail_text(routed).collect()}
    assert json.loads(got["dwd_trade_order_info"]) == {
        "id": "1", "amount": 1.5, "_source_table": "order_info", "_op": "c", "_ts_ms": 5}
    assert got["dirty_data"] == "{}"


def test_gate_keeps_text_unchanged(spark):
    judged = gate.with_gate_reason(text(spark, [' {"a":1} ', "x"]))
    assert [r.value for r in gate.passed(judged).collect()] == [' {"a":1} ']
    assert [(r.stage, r.value) for r in gate.dirty(judged, "ods_db").collect()] == [("ods_db", "x")]


RECORD = {"common": {"mid": "m1", "sid": "s1"}, "page": {"page_id": "p"}, "start": {"entry": "i"},
          "displays": [{"item": "1"}, {"item": "2"}], "actions": [{"action_id": "a", "ts": 1}],
          "err": {"error_code": 9}, "ts": 1704067200000}


def test_log_record_feeds_all_streams(spark):
    routed = logs.log_text(logs.split_logs(text(spark, [json.dumps(RECORD)])))
    got = {}
    for row in routed.collect():
        got.setdefault(row.route, []).append(json.loads(row.value))
    context = {"common": RECORD["common"], "page": RECORD["page"], "ts": RECORD["ts"]}
    assert got["dwd_traffic_page_log"] == got["dwd_traffic_start_log"] == [RECORD]
    assert got["dwd_traffic_display_log"] == [{"item": i, **context} for i in ("1", "2")]
    assert got["dwd_traffic_action_log"] == [{"action_id": "a", **context}]
    assert got["dwd_traffic_error_log"] == [{"error_code": 9, **context}]


def test_bad_logs_are_dirty_not_failures(spark):
    bad = [{**RECORD, "common": None}, {**RECORD, "common": "x"}, {**RECORD, "ts": None},
           {**RECORD, "common": {"mid": " "}}, {**RECORD, "page": None, "start": None},
           {**RECORD, "page": 7}, {**RECORD, "displays": {"a": 1}}, {**RECORD, "actions": [None]},
           {**RECORD, "err": [1]}]
    values = [json.dumps(b) for b in bad]
    routed = jobs.log_routes(text(spark, values)).orderBy("seq").collect()
    assert [(r.route, r.value) for r in routed] == [("dirty_data", v) for v in values]


def at(second):
    return F.timestamp_seconds(F.lit(1704067200) + second)


def dim_cells(spark, config, events):
    """config: (second, op, row); events: (second, op, table, row)."""
    c = spark.createDataFrame([(s, json.dumps({"op": o, ("before" if o == "d" else "after"): r}))
                               for s, o, r in config], "s int, value string")
    e = spark.createDataFrame(
        [(s, json.dumps({"op": o, "source": {"table": t}, ("before" if o == "d" else "after"): r}))
         for s, o, t, r in events], "s int, value string")
    c, e = [x.select("value", at(F.col("s")).alias("arrival_ts"), F.lit("").alias("seq"))
            for x in (c, e)]
    periods = dims.config_periods(dims.read_config(c))
    configured = dims.with_config(dims.read_dim_changes(e), periods)
    cells = dims.fold_cells(dims.cell_log(dims.project_dims(configured)))
    return {(r.row_key, f"{r.family}:{r.column}"): r.cell for r in cells.collect()}


def test_dim_rows_follow_config_and_nulls_and_deletes(spark):
    config = [(10, "r", {"source_table": "t", "sink_table": "dim_t", "sink_columns": "a, b"}),
              (50, "u", {"source_table": "t", "sink_table": "dim_t", "sink_type": "other"}),
              (60, "c", {"source_table": "t", "sink_table": "dim_t", "sink_family": "f"})]
    events = [
        (5, "c", "t", {"id": "0", "a": "early"}),         # before its configuration
        (10, "c", "t", {"id": 1, "a": "x", "b": 2, "z": "no"}),
        (11, "u", "t", {"id": 1, "a": None, "b": 3}),       # null keeps the old cell
        (12, "c", "t", {"id": "2", "a": "gone"}),
        (13, "d", "t", {"id": "2"}),
        (14, "c", "t", {"id": "2", "b": "new"}),            # a deleted row does not come back
        (15, "c", "t", {"a": "no key"}), (16, "c", "t", {"id": "", "a": "empty key"}),
        (17, "c", "t", {"id": " ", "a": "white key"}),
        (18, "d", "t", None),                               # nothing to delete
        (55, "c", "t", {"id": "3", "a": "removed config"}),
        (65, "c", "t", {"id": "4", "z": "all columns"})]
    assert dim_cells(spark, config, events) == {
        ("1", "info:a"): "x", ("1", "info:b"): "3", ("2", "info:b"): "new",
        (" ", "info:a"): "white key", ("4", "f:z"): "all columns"}


def test_dim_table_and_rows(spark):
    log = spark.createDataFrame(
        [("t", "1", "f", "a", "x"), ("t", "1", "f", "b", "y")],
        "sink_table string, row_key string, family string, column string, cell string")
    assert [tuple(r) for r in dims.dim_table(log, "t", ["a", "b"]).collect()] == [("1", "x", "y")]
    assert dims.dim_rows(log).first().cells == {"f:a": "x", "f:b": "y"}
