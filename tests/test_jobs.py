import datetime
import json
import random
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from rillhouse import session
from rillhouse.feeds import derive
from rillhouse.operators import changes, dims, facts, logs, replay, windows
from rillhouse.plans import tables
from rillhouse.sources import replay_text, table_snapshot_as_changes
from rillhouse.sources.schemas import DWD_ROUTES
from rillhouse.sources.text import jdbc_options
from rillhouse.streaming import fact_state, jobs, sinks
from rillhouse.streaming.batch_store import BatchStore


def write_text(spark, tmp_path, values):
    rows = spark.createDataFrame([(v, f"{i:03d}") for i, v in enumerate(values)],
                                 "value string, seq string")
    path = str(tmp_path / "in")
    (rows.withColumn("arrival_ts", F.current_timestamp())
     .select("value", "arrival_ts", "seq").coalesce(1).write.mode("append").parquet(path))
    return path


def run(writer, tmp_path, name="q"):
    sinks.start(writer, str(tmp_path / f"checkpoint-{name}"), name=name, once=True).awaitTermination()


def test_gate_job_routes_and_continues(spark, tmp_path):
    path, out = write_text(spark, tmp_path, ['{"a":1}', "x"]), str(tmp_path / "out")

    def once():
        text = replay_text(spark, path, streaming=True, max_files_per_trigger=1)
        run(jobs.gate_job(text, "ods_db", sinks.files(out, "route")), tmp_path, "gate")
        return sorted((r.route, r.value) for r in spark.read.parquet(out).collect())

    assert once() == [("dirty_data", "x"), ("ods_db", '{"a":1}')]
    assert len(once()) == 2                       # nothing new, nothing twice
    write_text(spark, tmp_path, ['{"b":2}'])
    assert len(once()) == 3


def test_repeated_batch_reaches_the_next_job_once(spark, tmp_path):
    """The last commit is taken away, so the batch runs again; a stream that follows and a
    batch reader both see its rows once."""
    path, mid, out = write_text(spark, tmp_path, ['{"a":1}']), str(tmp_path / "mid"), str(tmp_path / "out")

    def first():
        text = replay_text(spark, path, streaming=True, max_files_per_trigger=1)
        run(jobs.gate_job(text, "ods_db", sinks.files(mid)), tmp_path, "first")

    def second():
        rows = spark.readStream.schema("route string, value string, arrival_ts timestamp, seq string").parquet(mid)
        run(sinks.files(out)(rows), tmp_path, "second")
        return spark.read.parquet(out).count()

    first()
    assert second() == 1
    (tmp_path / "checkpoint-first" / "commits" / "0").unlink()
    for crc in (tmp_path / "checkpoint-first" / "commits").glob(".0.crc"):
        crc.unlink()
    first()
    assert second() == 1
    write_text(spark, tmp_path, ['{"b":2}'])
    first()
    assert second() == 2


def test_kafka_sink_names_topics(spark, tmp_path):
    """No broker here: the writer's rows and options are what can be checked."""
    path = write_text(spark, tmp_path, ['{"a":1}'])
    routed = jobs.gated_routes(replay_text(spark, path, streaming=True), "ods_db")
    rows, options = sinks.kafka_rows(routed), sinks.kafka_options("host:9092")
    assert rows.columns == ["topic", "value"] and options == {"kafka.bootstrap.servers": "host:9092"}


def test_text_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f'{{"a":{i}}}' for i in range(12)]
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "in" / "b.txt").write_text("x")
    read = replay_text(spark, str(tmp_path / "in"), fmt="text")
    assert [r.value for r in read.orderBy("seq").collect()] == [*lines, "x"]
    out = str(tmp_path / "out")
    run(sinks.files(out)(replay_text(spark, str(tmp_path / "in"), fmt="text", streaming=True)), tmp_path, "lines")
    assert [r.value for r in spark.read.parquet(out).orderBy("seq").collect()] == [*lines, "x"]


def test_jdbc_options():
    made = jdbc_options("jdbc:x", "t", partition_column="id", lower=1, upper=9, partitions=4, properties={"user": "u"})
    assert made == {"url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "1",
                    "upperBound": "9", "numPartitions": "4", "user": "u"}


def test_failed_query_is_restarted(spark, tmp_path):
    path, seen = write_text(spark, tmp_path, ["x"]), []

    def start():
        def write(batch, number):
            seen.append(number)
            if len(seen) < 3:
                raise ValueError("not yet")

        writer = sinks.each_batch(replay_text(spark, path, streaming=True), write)
        return sinks.start(writer, str(tmp_path / "checkpoint"), once=True)

    sinks.keep_running(start, attempts=3, pause_seconds=0)
    assert seen == [0, 0, 0]
    seen.clear()
    with pytest.raises(StreamingQueryException):
        write_text(spark, tmp_path, ["y"])
        sinks.keep_running(start, attempts=1, pause_seconds=0)


def test_console_sink_runs(spark, tmp_path):
    path = write_text(spark, tmp_path, ["x"])
    run(sinks.to_console(replay_text(spark, path, streaming=True)), tmp_path, "console")


def test_targets_appear_with_their_configuration(spark):
    config = dims.read_config(derive.config_text(spark))
    jobs.ensure_dim_targets(config, "dim_targets_test")
    jobs.ensure_dim_targets(config, "dim_targets_test")
    names = {r.tableName for r in spark.sql("SHOW TABLES IN dim_targets_test").collect()}
    assert {"dim_user_info", "dim_sku_info", "dim_base_province"} <= names
    families = [r.partition for r in spark.sql("SHOW PARTITIONS dim_targets_test.dim_sku_info").collect()]
    assert "family=cf" in families
    spark.sql("DROP DATABASE dim_targets_test CASCADE")


DETAIL = '{"id":"%s","order_id":"o","sku_id":"s","sku_num":"1","split_total_amount":"2.50"}'


def detail_batch(spark, *rows):
    """(table, JSON text, arrival second) as rows of the split's detail streams."""
    return spark.createDataFrame(
        [(DWD_ROUTES[t], text, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s), str(i))
         for i, (t, text, s) in enumerate(rows)], "route string, value string, arrival_ts timestamp, seq string")


def fact_ids(store, table):
    rows = store.table(table, fact_state.FACT_TABLE)
    return sorted(((r.id, r.user_id, r.activity_id, r.coupon_id, r._join_ts) for r in rows.collect()),
                  key=lambda x: (x[4], x[0], repr(x)))


def test_fact_state_lives_by_arrival_time(spark, tmp_path):
    """However long a job was down, rows of one half hour of arrival meet; state that lies
    further behind than TTL and lag is removed, in buckets no row falls into as well."""
    store = BatchStore(spark, str(tmp_path / "store"))
    write = fact_state.fact_batches(store, fact_state.BASE, ttl_seconds=100, lag_seconds=50, buckets=4)

    def held():
        return sum(b["rows"] for b in store.last()["state"][fact_state.BASE]["buckets"].values())

    write(detail_batch(spark, ("order_detail", DETAIL % 1, 0)), 0)
    write(detail_batch(spark, ("order_info", '{"id":"o","user_id":"u"}', 99)), 1)
    assert [x[:2] for x in fact_ids(store, fact_state.BASE)] == [("1", "u")] and held() == 1
    write(detail_batch(spark, ("order_info", '{"id":"o","user_id":"v"}', 100)), 2)   # the detail is too old
    assert len(fact_ids(store, fact_state.BASE)) == 1
    # other keys move the watermark on; order o was last written at second 100
    write(detail_batch(spark, *[("order_info", '{"id":"p%d"}' % i, 249) for i in range(8)]), 3)
    assert held() == 9
    write(detail_batch(spark, ("order_detail", (DETAIL % 2).replace('"o"', '"late"'), 150)), 4)   # 99 s behind others
    write(detail_batch(spark, ("order_info", '{"id":"late","user_id":"w"}', 160)), 5)
    assert [x[:2] for x in fact_ids(store, fact_state.BASE)] == [("1", "u"), ("2", "w")]
    write(detail_batch(spark, ("order_info", '{"id":"q"}', 251)), 6)
    assert held() == 10                                                  # o is gone; p0..p7, late, q stay
    write(detail_batch(spark, ("order_info", '{"id":"q"}', 1000)), 7)
    assert held() == 1


def test_repeated_and_failed_batches_change_nothing(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "store"))
    write = fact_state.fact_batches(store)
    first = detail_batch(spark, ("order_detail", DETAIL % 1, 0), ("order_info", '{"id":"o","user_id":"u"}', 1),
                         ("order_detail", DETAIL % "", 2))
    second = detail_batch(spark, ("order_detail_activity", '{"id":"9","order_detail_id":"1","activity_id":"a"}', 3),
                          ("order_detail_coupon", '{"id":"8","order_detail_id":"1","coupon_id":"c"}', 4))
    write(first, 0)
    before = store.last()
    write(first, 0)
    assert store.last() == before and len(fact_ids(store, fact_state.COUPON)) == 1

    turn = store.begin(1)   # a batch that fails before its commit leaves nothing behind
    turn.append(fact_state.COUPON, store.table(fact_state.COUPON, fact_state.FACT_TABLE))
    assert store.last() == before and len(fact_ids(store, fact_state.COUPON)) == 1
    write(second, 1)
    write(second, 1)
    assert [x[1:4] for x in fact_ids(store, fact_state.COUPON)] == [
        ("u", None, None), ("u", "a", None), ("u", "a", "c")]
    dirty = store.table(fact_state.DIRTY, fact_state.DIRTY_TABLE).collect()
    assert [(r.stage, r.reason) for r in dirty] == [("fact_order_detail", "missing key")]


def test_any_cut_into_batches_gives_the_same_facts(spark, tmp_path):
    """Against the batch form over everything, for several ways to cut the arrivals."""
    rng = random.Random(4)
    rows = []
    for second in range(0, 6000, 40):
        o, d = rng.randrange(5), rng.randrange(9)
        rows.append(rng.choice([
            ("order_detail", (DETAIL % d).replace('"o"', f'"o{o}"'), second),
            ("order_info", f'{{"id":"o{o}","user_id":"u{second}"}}', second),
            ("order_detail_activity", f'{{"id":"1","order_detail_id":"{d}","activity_id":"a{second}"}}', second),
            ("order_detail_coupon", f'{{"id":"1","order_detail_id":"{d}","coupon_id":"c{second}"}}', second)]))
    rows.sort(key=lambda r: r[2])
    good = [f.filter("reason IS NULL").drop("reason") for f in fact_state.read_inputs(detail_batch(spark, *rows)).values()]
    want = sorted(((r.id, r.user_id, r.activity_id, r.coupon_id, r._join_ts)
                   for r in replay.fact_changelog(*good).collect()), key=lambda x: (x[4], x[0], repr(x)))
    assert len(want) > 100
    for cuts in ([150], [10, 60, 61, 150]):
        store = BatchStore(spark, str(tmp_path / f"store{len(cuts)}"))
        write, at = fact_state.fact_batches(store, buckets=3), 0
        for number, end in enumerate(cuts):
            write(detail_batch(spark, *rows[at:end]), number)
            at = end
        assert fact_ids(store, fact_state.COUPON) == want


def test_late_rows_are_dropped(spark, tmp_path):
    """A row behind the watermark of an earlier batch does not come back into its window."""
    out = str(tmp_path / "windows")
    path = str(tmp_path / "in")

    def batch(*seconds):
        text = [('{"common":{"mid":"m%d"},"page":{},"ts":%d}' % (s, (1704067200 + s) * 1000),) for s in seconds]
        (spark.createDataFrame(text, "value string").select("value", F.current_timestamp().alias("arrival_ts"),
                                                            F.lit("").alias("seq"))
         .coalesce(1).write.mode("append").parquet(path))
        rows = logs.read_logs(replay_text(spark, path, streaming=True))
        run(jobs.traffic_window_job(rows, tables.window_writer(out)), tmp_path, "late")
        return sorted((r.stt.second + 60 * r.stt.minute, r.pv_ct) for r in spark.read.parquet(out).collect())

    assert batch(1, 29, 34) == [(0, 2)]
    assert batch(5, 40, 70) == [(0, 2), (30, 2)]   # second 5 is late, its window is closed
    assert batch(58, 200) == [(0, 2), (30, 2), (60, 1)]


def test_fact_job_from_detail_text(spark, tmp_path):
    """Detail text in, facts and rejected rows out, in one query; then the window's rejects."""
    rows = detail_batch(spark, ("order_detail", DETAIL % 1, 0), ("order_info", '{"id":"o","user_id":"u"}', 1),
                        ("order_detail", '{"id":"2","order_id":"o","sku_id":"s","sku_num":"x"}', 2))
    rows.write.parquet(str(tmp_path / "details"))
    store = BatchStore(spark, str(tmp_path / "facts"))
    for _ in range(2):
        run(jobs.fact_job(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "details")), store), tmp_path, "fact")
    fact = store.table(fact_state.COUPON, fact_state.FACT_TABLE).collect()
    assert [(r.id, r.user_id, r.split_total_amount) for r in fact] == [("1", "u", "2.50")]
    row = store.table(fact_state.DIRTY, fact_state.DIRTY_TABLE).first()
    assert (row.stage, row.reason, json.loads(row.value)["id"]) == ("fact_order_detail", "bad sku_num", "2")
    rejected = windows.parse_province_facts(store.table(fact_state.COUPON, fact_state.FACT_TABLE))
    assert rejected.first().reason == "missing province_id"


def test_tsv_batches_replace_themselves(spark, tmp_path):
    rows = spark.sql("SELECT timestamp'2024-01-01' AS stt, timestamp'2024-01-01' AS edt, date'2024-01-01' AS cur_date, "
                     "1L AS pv_ct, 1L AS uv_ct, 1L AS sv_ct, 0L AS ts")
    write = tables.tsv_writer("dws_traffic_page_view_window", str(tmp_path / "tsv"))
    for batch in (0, 1, 1):
        write(rows, batch)
    assert spark.read.text(str(tmp_path / "tsv")).count() == 2


def test_dirty_job(spark, tmp_path):
    path, out = write_text(spark, tmp_path, ['{"op":"x","table":"t"}']), str(tmp_path / "out")
    judged = changes.split_changes(replay_text(spark, path, streaming=True))
    run(jobs.dirty_job(judged, "dwd_split", sinks.files(out, "stage")), tmp_path, "dirty")
    row = spark.read.parquet(out).first()
    assert (row.stage, row.reason, json.loads(row.value)["op"]) == ("dwd_split", "unknown op", "x")


def test_snapshot_rows_read_as_changes(spark):
    rows = spark.createDataFrame([(1, Decimal("1.10"))], "id int, total_amount decimal(16,2)")
    text = table_snapshot_as_changes(rows, "payment_info")
    row = changes.detail_table(changes.split_changes(text), "payment_info").first()
    assert (row.id, row.total_amount, row._op) == ("1", "1.10", "r")


def test_compacted_dim_log_goes_on(spark, tmp_path):
    t = derive.Tables(spark, "/root/testdata/sf0.001")
    periods = dims.config_periods(dims.read_config(derive.config_text(spark)))

    def log_of(text):
        return dims.cell_log(dims.project_dims(dims.with_config(dims.read_dim_changes(text), periods)))

    everything = derive.dim_text(t)
    early, late = (everything.filter(f"seq {op} '3'") for op in ("<", ">="))
    path = str(tmp_path / "cells")
    dims.compact_log(log_of(early)).withColumn("batch_id", F.lit(-1)).write.partitionBy("sink_table", "batch_id").parquet(path)
    sinks.batch_files(path, "sink_table")(log_of(late), 0)
    sinks.batch_files(path, "sink_table")(log_of(late), 0)  # the batch runs again
    columns = [*dims.CELL, "cell"]
    stored = dims.fold_cells(spark.read.parquet(path))
    want = dims.fold_cells(log_of(everything))

    def rows(frame):
        return sorted(map(repr, frame.select(*columns).collect()))

    assert rows(stored) == rows(want)


def test_fact_text_round_trip(spark):
    made = spark.createDataFrame(
        [("1", None)], "id string, sku_name string")
    fields = {n: F.lit(None).cast("string") for n in facts.FACT_FIELDS if n not in made.columns}
    fact = made.select("*", *[c.alias(n) for n, c in fields.items()],
                       F.lit("order_detail").alias("_fact_type"), F.lit(5).cast("bigint").alias("_join_ts"))
    assert json.loads(facts.fact_text(fact).first().value) == {
        "id": "1", "_fact_type": "order_detail", "_join_ts": 5}


def test_scratch_is_in_the_shared_folder_and_cleared(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(1).write.parquet(path)
    session.clear_scratch(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_warehouse_serves_where_no_shared_folder_is_set():
    class Conf:
        def get(self, key, *default):
            return {"spark.sql.warehouse.dir": "file:/w"}.get(key, *default)

    class Session:
        conf = Conf()

    assert session.shared_dir(Session()) == "file:/w/scratch"
