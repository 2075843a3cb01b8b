import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillhouse.operators.ranking import rank_all, top_n
from rillhouse.plans import ads, dashboard, tables
from rillhouse.sources import from_kafka_rows, kafka_options
from rillhouse.sources.schemas import WINDOW_TABLES, window_schema


def window_tables(spark, empty=()):
    sku = [("s1", "00:00:00", "n1", "2024-01-01", "9.00"), ("s1", "10:00:00", "n1", "2024-01-02", "5.00"),
           ("s2", "10:00:30", "n2", "2024-01-02", "5.00"), ("s3", "11:00:00", "n3", "2024-01-02", "7.50")]
    made = {
        dashboard.SKU: [(s, f"{d} {t}", n, a) for s, t, n, d, a in sku],
        dashboard.PROVINCE: [(f"p{i % 2}", f"{d} {t}", None, a)
                             for i, (_, t, _, d, a) in enumerate(sku)],
        dashboard.TRAFFIC: [(None, "2024-01-02 10:00:00", None, None),
                            (None, "2024-01-02 10:00:30", None, None)]}
    result = {}
    for name, rows in made.items():
        base = spark.createDataFrame(rows, "k string, t string, n string, a string")
        base = base.filter(F.lit(name not in empty))
        stt = F.col("t").cast("timestamp")
        values = {"sku_id": F.col("k"), "province_id": F.col("k"), "stt": stt,
                  "edt": stt + F.expr("interval 30 seconds"), "sku_name": F.col("n"),
                  "cur_date": F.to_date(stt), "order_amount": F.col("a"), "order_count": F.lit(2),
                  "sku_num": F.lit(3), "pv_ct": F.lit(5), "uv_ct": F.lit(4), "sv_ct": F.lit(3),
                  "ts": F.lit(0)}
        result[name] = base.select(*[values[c].cast(k).alias(c)
                                     for c, k in WINDOW_TABLES[name].items()])
    return result


@pytest.mark.parametrize("limit, expected", [(None, 10), (0, 10), (-1, 10), (5, 5), (50, 50), (51, 50)])
def test_limit_clamp(limit, expected):
    assert dashboard.clamp_limit(limit) == expected


def test_views_use_newest_day_and_break_ties(spark):
    t = window_tables(spark)
    rank = ads.view("ads_trade_sku_order_topn_today", t)
    assert [(r.rn, r.sku_id) for r in rank.orderBy("rn").collect()] == [
        (1, "s3"), (2, "s1"), (3, "s2")]
    stats = ads.view("ads_trade_stats_today", t).first()
    assert (float(stats.gmv), stats.ordered_sku_count, stats.sku_order_count) == (17.5, 3, 6)
    hours = ads.view("ads_trade_hour_stats_today", t).orderBy("hour_time").collect()
    assert [(r.hour_time, r.ordered_sku_count) for r in hours] == [("10:00:00", 2), ("11:00:00", 1)]
    traffic = ads.view("ads_traffic_stats_today", t).first()
    assert (traffic.pv_ct, traffic.uv_ct) == (10, 8)  # visitors of each window added up


def test_sql_reports_equal_frame_reports(spark):
    t = window_tables(spark)
    ads.register_views(t)
    pairs = {"trade_trend": dashboard.trade_trend(t), "traffic_trend": dashboard.traffic_trend(t),
             "sku_topn": dashboard.sku_topn(t, 2), "province_topn": dashboard.province_topn(t, 2),
             "hour_trade": dashboard.hour_trade(t), "hour_traffic": dashboard.hour_traffic(t)}
    assert {*pairs, "trade_stats", "traffic_stats"} == set(dashboard.REPORTS)
    for name, frame in pairs.items():
        by_sql = dashboard.sql_report(spark, name, 2)
        key = [c for c in ("rn", "stt", "hour_time") if c in by_sql.columns][:1]
        assert by_sql.orderBy(*key).collect() == frame.select(*by_sql.columns).orderBy(*key).collect()
    assert set(dashboard.hour_trend(t)) == {"trade", "traffic"}


@pytest.mark.parametrize("empty", [(), (dashboard.SKU,), (dashboard.TRAFFIC,)])
def test_summary_with_missing_sides(spark, empty):
    row = dashboard.summary(window_tables(spark, empty)).first()
    assert row.cur_date == "2024-01-02"
    assert row.latest_window_time == ("2024-01-02 10:01:00" if dashboard.SKU in empty
                                      else "2024-01-02 11:00:30")
    assert (row.trade_gmv is None) == (dashboard.SKU in empty)


def test_summary_of_nothing(spark):
    assert dashboard.summary(window_tables(spark, (dashboard.SKU, dashboard.TRAFFIC))).count() == 0


def test_banded_rank_is_row_number(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500)
        .cast("decimal(16,2)").alias("v"), F.col("id").cast("string").alias("t"),
        F.lit("d").alias("cur_date"))
    whole = Window.partitionBy("cur_date").orderBy(F.col("v").desc(), "t")
    both = (rank_all(rows, "v", "t").withColumn("want", F.row_number().over(whole)))
    assert both.filter("rn <> want").count() == 0 and both.count() == 3000
    assert top_n(rows, "v", "t", 7).count() == 7
    assert rank_all(rows.limit(0), "v", "t").count() == 0


def test_window_table_files_are_idempotent(spark, tmp_path):
    sku = window_tables(spark)[dashboard.SKU]
    path = str(tmp_path / "sku")
    for batch in (0, 1, 1):
        tables.write_windows(sku, path, batch, files=2)
    back = tables.read_windows(spark, path, dashboard.SKU)
    assert back.count() == 2 * sku.count() and back.columns == list(WINDOW_TABLES[dashboard.SKU])
    plan = ads.today(back)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cur_date" in plan


def test_catalog_tables(spark):
    tables.create_window_tables(spark, "reports_test", buckets=2)
    rows = window_tables(spark)[dashboard.PROVINCE]
    tables.insert_windows(rows, "reports_test", dashboard.PROVINCE)
    assert spark.table(f"reports_test.{dashboard.PROVINCE}").count() == rows.count()
    assert "INTO 10 BUCKETS" in tables.window_table_ddl(dashboard.SKU, "x")
    assert "ts bigint" in window_schema(dashboard.SKU)
    spark.sql("DROP DATABASE reports_test CASCADE")


def test_tsv_export(spark):
    line = tables.window_tsv(window_tables(spark)[dashboard.SKU], dashboard.SKU).first().line
    assert line == "s1\t2024-01-01 00:00:00\t2024-01-01 00:00:30\tn1\t2024-01-01\t9.00\t2\t3\t0"


def test_kafka_options_and_columns(spark):
    options = kafka_options("h:1", "t")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t"
    assert "maxOffsetsPerTrigger" in options
    rows = spark.range(1).select(
        F.encode(F.lit("{}"), "utf-8").alias("value"), F.current_timestamp().alias("timestamp"),
        F.lit(3).alias("partition"), F.lit(12).cast("bigint").alias("offset"))
    row = from_kafka_rows(rows).first()
    assert (row.value, row.seq) == ("{}", "00003-0000000000000000012")
