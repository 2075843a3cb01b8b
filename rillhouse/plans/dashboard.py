"""The six dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.functions import first_non_blank, string_max, to_label
from rillhouse.operators.ranking import top_n
from rillhouse.plans import ads

DEFAULT_TOP_N = 10
MAX_TOP_N = 50

SKU, PROVINCE, TRAFFIC = ("dws_trade_sku_order_window", "dws_trade_province_order_window",
                          "dws_traffic_page_view_window")

# reports as SQL over the registered views: view, order, and whether they take a limit
REPORTS = {
    "trade_stats": ("ads_trade_stats_today", "cur_date", False),
    "traffic_stats": ("ads_traffic_stats_today", "cur_date", False),
    "trade_trend": ("ads_trade_trend_30s", "stt", False),
    "traffic_trend": ("ads_traffic_page_view_trend_30s", "stt", False),
    "sku_topn": ("ads_trade_sku_order_topn_today", "order_amount DESC, sku_id", True),
    "province_topn": ("ads_trade_province_order_topn_today", "gmv DESC, province_id", True),
    "hour_trade": ("ads_trade_hour_stats_today", "hour_time", False),
    "hour_traffic": ("ads_traffic_hour_stats_today", "hour_time", False),
}


def clamp_limit(limit: int | None) -> int:
    """Missing or non-positive gives 10; more than 50 gives 50."""
    if limit is None or limit <= 0:
        return DEFAULT_TOP_N
    return min(limit, MAX_TOP_N)


def with_labels(rows: DataFrame) -> DataFrame:
    """Timestamps and dates as the strings the dashboard shows."""
    return rows.select(*[to_label(F.col(n), t).alias(n) for n, t in rows.dtypes])


def sql_report(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """A report as SQL over the registered views; the limit is bound, never pasted."""
    view, order, limited = REPORTS[name]
    columns = [c for c in spark.table(view).columns if c != "ts"]
    text = f"SELECT {', '.join(columns)} FROM {view} ORDER BY {order}"
    args = [clamp_limit(limit)] if limited else None
    return with_labels(spark.sql(text + " LIMIT ?" * limited, args=args))


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Trade and traffic totals of the newest day in one row; either may be missing."""
    trade = with_labels(ads.trade_stats_today(tables[SKU])).limit(1)
    traffic = with_labels(ads.traffic_stats_today(tables[TRAFFIC])).limit(1)
    left = trade.select(F.lit(1).alias("one"), *[F.col(n).alias(f"trade_{n}")
                                                 for n in trade.columns])
    right = traffic.select(F.lit(1).alias("one"), *[F.col(n).alias(f"traffic_{n}")
                                                    for n in traffic.columns])
    c = F.col
    both = left.join(right, "one", "full")
    return both.drop("one").select(
        "*",
        first_non_blank(c("trade_cur_date"), c("traffic_cur_date")).alias("cur_date"),
        string_max(c("trade_latest_window_time"),
                   c("traffic_latest_window_time")).alias("latest_window_time"))


def trade_trend(tables: dict[str, DataFrame]) -> DataFrame:
    return with_labels(ads.trade_trend_30s(tables[SKU]).orderBy("stt"))


def traffic_trend(tables: dict[str, DataFrame]) -> DataFrame:
    return with_labels(ads.traffic_page_view_trend_30s(tables[TRAFFIC]).orderBy("stt"))


def sku_topn(tables: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    best = top_n(ads.sku_totals_today(tables[SKU]), "order_amount", "sku_id", clamp_limit(limit))
    return with_labels(best.orderBy("rn"))


def province_topn(tables: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    best = top_n(ads.trade_province_order_today(tables[PROVINCE]).drop("latest_window_time"),
                 "gmv", "province_id", clamp_limit(limit))
    return with_labels(best.orderBy("rn"))


def hour_trade(tables: dict[str, DataFrame]) -> DataFrame:
    return with_labels(ads.trade_hour_stats_today(tables[SKU]).orderBy("hour_time"))


def hour_traffic(tables: dict[str, DataFrame]) -> DataFrame:
    return with_labels(ads.traffic_hour_stats_today(tables[TRAFFIC]).orderBy("hour_time"))


def hour_trend(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"trade": hour_trade(tables), "traffic": hour_traffic(tables)}
