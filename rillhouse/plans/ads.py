"""Reporting views over the window tables.

"Today" is the newest ``cur_date`` in the table, not the calendar day.  Of a stored
table it is read from the names of its partitions and bound as a literal, so a report
opens files of that day only; other frames are asked by a scalar subquery.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.functions import hour_label, now_millis
from rillhouse.operators.ranking import rank_all

_DAY = re.compile(r"/(?:cur_date|_day)=(\d{4}-\d{2}-\d{2})/")


def today(windows: DataFrame) -> DataFrame:
    days = (_DAY.search(path) for path in windows.inputFiles())
    newest = max((day[1] for day in days if day), default=None)
    if newest is None:
        return windows.filter(F.col("cur_date") == windows.agg(F.max("cur_date")).scalar())
    return windows.filter(F.col("cur_date") == F.lit(newest).cast("date"))


def _trade(amount: str, count: str) -> list[Column]:
    return [F.sum("order_amount").alias(amount), F.sum("order_count").alias(count),
            F.sum("sku_num").alias("sku_num")]


def _skus() -> Column:
    return F.count_distinct("sku_id").alias("ordered_sku_count")


def _traffic() -> list[Column]:
    # day and hour figures add up the visitors of each window
    return [F.sum("pv_ct").alias("pv_ct"), F.sum("uv_ct").alias("uv_ct"),
            F.sum("sv_ct").alias("sv_ct")]


def _newest() -> Column:
    return F.max("edt").alias("latest_window_time")


def _by_hour(windows: DataFrame) -> DataFrame:
    return today(windows).groupBy("cur_date", hour_label(F.col("stt")).alias("hour_time"))


def trade_stats_today(sku: DataFrame) -> DataFrame:
    return today(sku).groupBy("cur_date").agg(
        *_trade("gmv", "sku_order_count"), _skus(), _newest())


def sku_totals_today(sku: DataFrame) -> DataFrame:
    return today(sku).groupBy("cur_date", "sku_id").agg(
        F.max("sku_name").alias("sku_name"), *_trade("order_amount", "sku_order_count"))


def trade_sku_order_topn_today(sku: DataFrame) -> DataFrame:
    """Every product of the day with its place by amount (ties by product id)."""
    ranked = rank_all(sku_totals_today(sku), "order_amount", "sku_id")
    return ranked.select("cur_date", "sku_id", "sku_name", "order_amount", "sku_order_count",
                         "sku_num", "rn")


def trade_trend_30s(sku: DataFrame) -> DataFrame:
    return today(sku).groupBy("stt", "edt", "cur_date").agg(
        *_trade("gmv", "sku_order_count"), _skus())


def trade_hour_stats_today(sku: DataFrame) -> DataFrame:
    return _by_hour(sku).agg(*_trade("gmv", "sku_order_count"), _skus())


def trade_province_order_today(province: DataFrame) -> DataFrame:
    return today(province).groupBy("cur_date", "province_id").agg(
        *_trade("gmv", "province_order_count"), _newest())


def trade_province_order_topn_today(province: DataFrame) -> DataFrame:
    ranked = rank_all(trade_province_order_today(province), "gmv", "province_id")
    return ranked.select("cur_date", "province_id", "gmv", "province_order_count", "sku_num", "rn")


def traffic_stats_today(traffic: DataFrame) -> DataFrame:
    return today(traffic).groupBy("cur_date").agg(*_traffic(), _newest())


def traffic_page_view_trend_30s(traffic: DataFrame) -> DataFrame:
    return today(traffic).groupBy("stt", "edt", "cur_date").agg(*_traffic())


def traffic_hour_stats_today(traffic: DataFrame) -> DataFrame:
    return _by_hour(traffic).agg(*_traffic())


# view name -> (window table, definition); names are fixed values
VIEWS = {
    "ads_trade_stats_today": ("dws_trade_sku_order_window", trade_stats_today),
    "ads_trade_sku_order_topn_today": ("dws_trade_sku_order_window", trade_sku_order_topn_today),
    "ads_trade_trend_30s": ("dws_trade_sku_order_window", trade_trend_30s),
    "ads_trade_hour_stats_today": ("dws_trade_sku_order_window", trade_hour_stats_today),
    "ads_trade_province_order_today": ("dws_trade_province_order_window",
                                       trade_province_order_today),
    "ads_trade_province_order_topn_today": ("dws_trade_province_order_window",
                                            trade_province_order_topn_today),
    "ads_traffic_stats_today": ("dws_traffic_page_view_window", traffic_stats_today),
    "ads_traffic_page_view_trend_30s": ("dws_traffic_page_view_window",
                                        traffic_page_view_trend_30s),
    "ads_traffic_hour_stats_today": ("dws_traffic_page_view_window", traffic_hour_stats_today),
}


def view(name: str, tables: dict[str, DataFrame], with_ts: bool = True) -> DataFrame:
    """A view by name; ``ts`` is the time of the query."""
    table, define = VIEWS[name]
    rows = define(tables[table])
    return rows.withColumn("ts", now_millis()) if with_ts else rows


def register_views(tables: dict[str, DataFrame]) -> None:
    """(Re)create all views and the window tables as temporary views for SQL users."""
    for table, rows in tables.items():
        rows.createOrReplaceTempView(table)
    for name in VIEWS:
        view(name, tables).createOrReplaceTempView(name)
