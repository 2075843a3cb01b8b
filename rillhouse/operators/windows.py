"""30-second window tables.

The same functions run on batch and streaming frames: on a stream, pass
``watermark`` and start the query in append mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.functions import (
    is_blank, is_object_text, millis_to_timestamp, now_millis, parse_amount, parse_event_time,
    parse_integer, parse_once, round_money, sum_whole,
)
from rillhouse.sources.schemas import FACT_SCHEMA, WINDOW_TABLES

WINDOW_LENGTH = "30 seconds"
WATERMARK = "3 seconds"


def read_facts(rows: DataFrame) -> DataFrame:
    """Typed facts from JSON text."""
    return parse_once(rows, "value", FACT_SCHEMA)


def _with_event_time(facts: DataFrame, time_mode: str) -> DataFrame:
    """``processing``: the clock (as the live dashboard wants it); ``event``: the
    order's own time, so that reruns give the same windows."""
    now = F.current_timestamp()
    return facts.withColumn(
        "event_ts", now if time_mode == "processing" else parse_event_time(F.col("create_time"), now))


SKU_KEYS, PROVINCE_KEYS = ["sku_id", "order_id"], ["province_id"]
#: What the window tables read of a fact.
SKU_COLUMNS = ["id", "sku_id", "order_id", "sku_name", "split_total_amount", "sku_num", "create_time", "_join_ts"]
PROVINCE_COLUMNS = ["province_id", "split_total_amount", "sku_num", "create_time"]


def _order_reason(keys: list[str]) -> Column:
    missing = is_blank(F.col(keys[0]))
    for key in keys[1:]:
        missing = missing | is_blank(F.col(key))
    return (F.when(missing, F.lit("missing " + " or ".join(keys)))
            .when(parse_amount(F.col("split_total_amount")).isNull(), F.lit("bad amount"))
            .when(parse_integer(F.col("sku_num")).isNull(), F.lit("bad sku_num")))


def sku_reason() -> Column:
    """Why the product windows reject a fact (null when they do not)."""
    return _order_reason(SKU_KEYS)


def province_reason() -> Column:
    return _order_reason(PROVINCE_KEYS)


def _parse_order_facts(facts: DataFrame, reason: Column, time_mode: str) -> DataFrame:
    return (_with_event_time(facts, time_mode).withColumn("amount", parse_amount(F.col("split_total_amount")))
            .withColumn("num", parse_integer(F.col("sku_num"))).withColumn("reason", reason))


def parse_sku_facts(facts: DataFrame, time_mode: str = "event") -> DataFrame:
    """Add ``event_ts, amount, num`` and ``reason`` (null when usable)."""
    return _parse_order_facts(facts, sku_reason(), time_mode)


def parse_province_facts(facts: DataFrame, time_mode: str = "event") -> DataFrame:
    return _parse_order_facts(facts, province_reason(), time_mode)


def parse_page_views(logs: DataFrame) -> DataFrame:
    """From the columns of ``logs.read_logs`` to ``mid, sid, event_ts`` and ``reason``."""
    c = F.col
    reason = (F.when(~is_object_text(c("common")) | ~is_object_text(c("page")) | c("ts").isNull(),
                     F.lit("missing common, page or ts"))
              .when(is_blank(c("mid")), F.lit("missing mid"))
              .when(millis_to_timestamp(c("ts")).isNull(), F.lit("bad ts")))
    return logs.withColumn("event_ts", millis_to_timestamp(c("ts"))).withColumn("reason", reason)


def _usable(rows: DataFrame, watermark: str | None) -> DataFrame:
    good = rows.filter(F.col("reason").isNull())
    return good.withWatermark("event_ts", watermark) if watermark else good


def _finish(windowed: DataFrame, table: str, with_ts: bool) -> DataFrame:
    """Window bounds as columns, in table order; ``ts`` is the write time."""
    result = (windowed.withColumn("stt", F.col("window.start")).withColumn("edt", F.col("window.end"))
              .withColumn("cur_date", F.to_date("stt")).withColumn("ts", now_millis()))
    return result.select(*[n for n in WINDOW_TABLES[table] if with_ts or n != "ts"])


def sku_windows(parsed: DataFrame, *, watermark: str | None = None,
                with_ts: bool = True) -> DataFrame:
    """Amount, number of detail rows and pieces per product; ``sku_name`` is the first
    non-blank name of the window in arrival order."""
    named = F.when(~is_blank(F.col("sku_name")), F.struct("_join_ts", "id", "sku_name"))
    totals = (_usable(parsed, watermark)
              .groupBy(F.window("event_ts", WINDOW_LENGTH), "sku_id")
              .agg(round_money(F.try_sum("amount")).alias("order_amount"),
                   F.count(F.lit(1)).alias("order_count"),
                   sum_whole(F.col("num")).alias("sku_num"),
                   F.min(named)["sku_name"].alias("sku_name")))
    return _finish(totals, "dws_trade_sku_order_window", with_ts)


def province_windows(parsed: DataFrame, *, watermark: str | None = None,
                     with_ts: bool = True) -> DataFrame:
    totals = (_usable(parsed, watermark)
              .groupBy(F.window("event_ts", WINDOW_LENGTH), "province_id")
              .agg(round_money(F.try_sum("amount")).alias("order_amount"),
                   F.count(F.lit(1)).alias("order_count"),
                   sum_whole(F.col("num")).alias("sku_num")))
    return _finish(totals, "dws_trade_province_order_window", with_ts)


def traffic_windows(parsed: DataFrame, *, watermark: str | None = None,
                    with_ts: bool = True) -> DataFrame:
    """Views, visitors (mid) and sessions (non-blank sid) of all pages together.

    Streams cannot count distinct values in one step, and a set per window would
    grow without bound.  Each view becomes one row per id; counting per id first
    leaves one row per visitor and session, which spreads a busy window over all
    tasks and lets each task combine its rows before the shuffle.
    """
    visitor = F.struct(F.lit("mid").alias("kind"), F.col("mid").alias("id"))
    session = F.struct(F.lit("sid").alias("kind"), F.col("sid").alias("id"))
    ids = F.when(is_blank(F.col("sid")), F.array(visitor)).otherwise(F.array(visitor, session))
    per_id = (_usable(parsed, watermark)
              .select("event_ts", F.explode(ids).alias("i")).select("event_ts", "i.kind", "i.id")
              .groupBy(F.window("event_ts", WINDOW_LENGTH), "kind", "id")
              .agg(F.count(F.lit(1)).alias("n")))
    is_visitor = F.col("kind") == "mid"
    totals = per_id.groupBy("window").agg(
        F.sum(F.when(is_visitor, F.col("n")).otherwise(F.lit(0))).alias("pv_ct"),
        F.count(F.when(is_visitor, F.lit(1))).alias("uv_ct"),
        F.count(F.when(~is_visitor, F.lit(1))).alias("sv_ct"))
    return _finish(totals, "dws_traffic_page_view_window", with_ts)
