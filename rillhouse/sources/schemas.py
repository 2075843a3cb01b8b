"""Table and stream layouts.

Everything that arrives is text; the names and column lists below are fixed
values, because consumers of the tables and views rely on them.
"""

from __future__ import annotations

# one document per row; seq breaks ties between rows with the same arrival time
TEXT_SCHEMA = "value string, arrival_ts timestamp, seq string"

# change event; nested parts stay JSON text until their table is known
CHANGE_SCHEMA = "op string, source string, `table` string, before string, after string, ts_ms string"

# app log record; nested parts stay JSON text
LOG_SCHEMA = ("common string, page string, start string, displays string, actions string, "
              "err string, ts string")

# source table -> detail stream (fixed values)
DWD_ROUTES = {
    "cart_info": "dwd_trade_cart_info",
    "order_info": "dwd_trade_order_info",
    "order_detail": "dwd_trade_order_detail",
    "order_detail_activity": "dwd_trade_order_detail_activity",
    "order_detail_coupon": "dwd_trade_order_detail_coupon",
    "payment_info": "dwd_trade_payment_info",
    "order_refund_info": "dwd_trade_order_refund_info",
    "refund_payment": "dwd_trade_refund_payment",
    "order_status_log": "dwd_trade_order_status_log",
    "coupon_use": "dwd_tool_coupon_use",
    "favor_info": "dwd_interaction_favor_info",
    "comment_info": "dwd_interaction_comment_info",
}

# log streams (fixed values)
LOG_ROUTES = {
    "page": "dwd_traffic_page_log",
    "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log",
    "action": "dwd_traffic_action_log",
    "error": "dwd_traffic_error_log",
}

DIRTY_STREAM = "dirty_data"
FACT_STREAM = "dwd_trade_order_detail_fact"

# fields the fact join reads from its four inputs
DETAIL_FIELDS = ["id", "order_id", "sku_id", "sku_name", "order_price", "sku_num",
                 "split_total_amount", "split_activity_amount", "split_coupon_amount", "create_time"]
ORDER_FIELDS = ["id", "user_id", "province_id", "order_status", "payment_way",
                "original_total_amount"]
ACTIVITY_FIELDS = ["order_detail_id", "activity_id", "activity_rule_id"]
COUPON_FIELDS = ["order_detail_id", "coupon_id", "coupon_use_id"]

FACT_FIELDS = DETAIL_FIELDS + ORDER_FIELDS[1:] + ACTIVITY_FIELDS[1:] + COUPON_FIELDS[1:]

FACT_SCHEMA = (", ".join(f"{name} string" for name in FACT_FIELDS)
               + ", _fact_type string, _join_ts bigint")

# text columns read from each detail stream once its table is known
DWD_FIELDS = {
    "cart_info": ["id", "user_id", "sku_id", "sku_num"],
    "order_info": ORDER_FIELDS,
    "order_detail": DETAIL_FIELDS,
    "order_detail_activity": ["id"] + ACTIVITY_FIELDS,
    "order_detail_coupon": ["id"] + COUPON_FIELDS,
    "payment_info": ["id", "order_id", "total_amount"],
    "order_refund_info": ["id", "order_id", "sku_id", "refund_amount"],
    "refund_payment": ["id", "order_id", "total_amount"],
    "order_status_log": ["id", "order_id", "order_status"],
    "coupon_use": ["id", "coupon_id", "order_id"],
    "favor_info": ["id", "user_id", "sku_id"],
    "comment_info": ["id", "user_id", "sku_id"],
}

DIM_CONFIG_FIELDS = ["source_table", "sink_table", "sink_family", "sink_row_key",
                     "sink_columns", "sink_type"]

# window tables: column, type (fixed values, in the order of the text export)
SKU_WINDOW = {"sku_id": "string", "stt": "timestamp", "edt": "timestamp", "sku_name": "string",
              "cur_date": "date", "order_amount": "decimal(16,2)", "order_count": "bigint",
              "sku_num": "bigint", "ts": "bigint"}
PROVINCE_WINDOW = {"province_id": "string", "stt": "timestamp", "edt": "timestamp",
                   "cur_date": "date", "order_amount": "decimal(16,2)", "order_count": "bigint",
                   "sku_num": "bigint", "ts": "bigint"}
TRAFFIC_WINDOW = {"stt": "timestamp", "edt": "timestamp", "cur_date": "date", "pv_ct": "bigint",
                  "uv_ct": "bigint", "sv_ct": "bigint", "ts": "bigint"}

WINDOW_TABLES = {
    "dws_trade_sku_order_window": SKU_WINDOW,
    "dws_trade_province_order_window": PROVINCE_WINDOW,
    "dws_traffic_page_view_window": TRAFFIC_WINDOW,
}


def window_schema(table: str, with_ts: bool = True) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in WINDOW_TABLES[table].items()
                     if with_ts or name != "ts")
