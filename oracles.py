"""Comparison SQL (DuckDB) for the registered queries.

Every statement starts from the given tables and states the feed rules and the
operator in plain SQL; nothing here is computed by Spark.
"""

from __future__ import annotations

ROUTES = {
    "cart_info": "dwd_trade_cart_info", "order_info": "dwd_trade_order_info",
    "order_detail": "dwd_trade_order_detail",
    "order_detail_activity": "dwd_trade_order_detail_activity",
    "order_detail_coupon": "dwd_trade_order_detail_coupon",
    "payment_info": "dwd_trade_payment_info",
    "order_refund_info": "dwd_trade_order_refund_info",
    "refund_payment": "dwd_trade_refund_payment",
    "order_status_log": "dwd_trade_order_status_log", "coupon_use": "dwd_tool_coupon_use",
    "favor_info": "dwd_interaction_favor_info", "comment_info": "dwd_interaction_comment_info",
}

T0 = 1704067200


def ts(sec: str) -> str:
    return f"strftime(make_timestamp(CAST({sec} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


def day(sec: str) -> str:
    return f"strftime(make_timestamp(CAST({sec} AS BIGINT) * 1000000), '%Y-%m-%d')"


# ---------------------------------------------------------------- feed rules

FEED = f"""
lines AS (
  SELECT l_orderkey AS o, l_linenumber AS ln, l_partkey, l_suppkey,
         l_orderkey * 100 + l_linenumber AS k,
         CAST(l_orderkey * 100 + l_linenumber AS VARCHAR) AS id,
         CAST(l_quantity AS BIGINT) AS qty,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS price,
         CAST(l_discount AS DECIMAL(4,2)) AS disc,
         l_returnflag AS flag, l_linestatus AS status,
         concat_ws('|', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
           CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR),
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
           CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR),
           CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR),
           strftime(l_shipdate, '%Y-%m-%d'), l_returnflag, l_linestatus) AS seq,
         {T0} + (l_orderkey % 2) * 86400 + (l_orderkey * 17) % 10800 AS sec
  FROM lineitem),
det AS (
  SELECT k, id, CASE WHEN k % 103 = 0 THEN '' ELSE CAST(o AS VARCHAR) END AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         CASE WHEN k % 5 = 0 THEN ' ' ELSE p_name || ' v' || CAST(ln % 3 AS VARCHAR) END AS sku_name,
         CAST(price AS VARCHAR) AS order_price,
         CASE WHEN k % 103 = 1 THEN '12.7' ELSE CAST(qty AS VARCHAR) END AS sku_num,
         CASE k % 103 WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN '1e3' WHEN 9 THEN '1e15'
           ELSE CAST(CAST(round(price * (1 - disc), 2) AS DECIMAL(16,2)) AS VARCHAR) END
           AS split_total_amount,
         CASE WHEN disc >= 0.05
           THEN CAST(CAST(round(price * disc, 2) AS DECIMAL(16,2)) AS VARCHAR) ELSE '' END
           AS split_activity_amount,
         CASE WHEN flag = 'R' THEN '1.00' ELSE '' END AS split_coupon_amount,
         {ts('sec')} AS create_time, sec, (o * 31 + ln * 700) % 5000 AS arr, seq
  FROM lines JOIN part ON l_partkey = p_partkey),
act AS (
  SELECT k, id, CASE WHEN k % 103 = 7 THEN '  ' ELSE id END AS order_detail_id,
         p_brand AS activity_id, CAST(l_partkey % 10 AS VARCHAR) AS activity_rule_id,
         sec, (o * 31 + ln * 700 + 900) % 5000 AS arr, seq
  FROM lines JOIN part ON l_partkey = p_partkey WHERE disc >= 0.05),
cou AS (
  SELECT k, id, CASE WHEN k % 103 <> 8 THEN id END AS order_detail_id,
         CAST(l_suppkey AS VARCHAR) AS coupon_id, CAST(k + 5 AS VARCHAR) AS coupon_use_id,
         sec, (o * 31 + ln * 700 + 2500) % 5000 AS arr, seq
  FROM lines WHERE flag = 'R'),
ord AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(c_nationkey AS VARCHAR) AS province_id, o_orderstatus AS order_status,
         o_orderpriority AS payment_way,
         CASE o_orderkey % 103 WHEN 5 THEN 'x1' WHEN 6 THEN ' '
           ELSE CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) END AS original_total_amount,
         {T0} + (o_orderkey % 2) * 86400 + (o_orderkey * 17) % 10800 AS sec,
         (o_orderkey * 31 + 1200) % 5000 AS arr, '' AS seq
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

# the same rows as they come out of the change-event text: damaged events and deletes left out
E2E_FEED = FEED
for _name in ("det", "act", "cou", "ord"):
    E2E_FEED = E2E_FEED.replace(f"\n{_name} AS (", f"\n{_name}_all AS (")
E2E_FEED += "," + ",".join(
    f"\n{_name} AS (SELECT * FROM {_name}_all WHERE k % 101 NOT BETWEEN 0 AND 4 AND k % 97 <> 0)"
    for _name in ("det", "act", "cou", "ord"))

EVENTS = f"""
ev AS (
  SELECT event_id AS e, user_id, event_type AS kind,
         {T0} + (event_id % 2) * 86400 + (event_id * 7) % 3600 AS sec
  FROM events)"""

# rows of every change table: name -> SELECT with k, id, sec, further columns
CHANGE_ROWS = {
    "order_detail": "SELECT * FROM det",
    "order_info": "SELECT * FROM ord",
    "order_detail_activity": "SELECT * FROM act",
    "order_detail_coupon": "SELECT * FROM cou",
    "payment_info": "SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, "
                    "CAST(o_orderkey AS VARCHAR) AS order_id, "
                    "CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount, ord.sec "
                    "FROM orders JOIN ord ON o_orderkey = ord.k WHERE o_orderstatus = 'F'",
    "refund_payment": "SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, "
                      "CAST(o_orderkey AS VARCHAR) AS order_id, "
                      "CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount, ord.sec "
                      "FROM orders JOIN ord ON o_orderkey = ord.k WHERE o_orderstatus = 'P'",
    "order_status_log": "SELECT k, id, id AS order_id, order_status, sec FROM ord",
    "order_refund_info": "SELECT k, id, CAST(o AS VARCHAR) AS order_id, "
                         "CAST(l_partkey AS VARCHAR) AS sku_id, CAST(price AS VARCHAR) "
                         "AS refund_amount, sec FROM lines WHERE flag = 'R' AND status = 'F'",
    "coupon_use": "SELECT k, id, CAST(l_suppkey AS VARCHAR) AS coupon_id, "
                  "CAST(o AS VARCHAR) AS order_id, sec FROM lines WHERE flag = 'R'",
    "cart_info": "SELECT e AS k, CAST(e AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, "
                 "CAST(e % 200 AS VARCHAR) AS sku_id, '1' AS sku_num, sec FROM ev "
                 "WHERE kind = 'click'",
    "favor_info": "SELECT e AS k, CAST(e AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, "
                  "CAST(e % 200 AS VARCHAR) AS sku_id, sec FROM ev WHERE kind = 'view'",
    "comment_info": "SELECT e AS k, CAST(e AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, "
                    "CAST(e % 200 AS VARCHAR) AS sku_id, sec FROM ev WHERE kind = 'purchase'",
    "user_info": "SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS id, 0 AS sec FROM customer",
    "sku_info": "SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS id, 0 AS sec FROM part",
    "base_province": "SELECT n_nationkey AS k, CAST(n_nationkey AS VARCHAR) AS id, 0 AS sec "
                     "FROM nation",
}

DWD_COLUMNS = {
    "cart_info": "id, user_id, sku_id, sku_num",
    "order_info": "id, user_id, province_id, order_status, payment_way, original_total_amount",
    "order_detail": "id, order_id, sku_id, sku_name, order_price, sku_num, split_total_amount, "
                    "split_activity_amount, split_coupon_amount, create_time",
    "order_detail_activity": "id, order_detail_id, activity_id, activity_rule_id",
    "order_detail_coupon": "id, order_detail_id, coupon_id, coupon_use_id",
    "payment_info": "id, order_id, total_amount",
    "order_refund_info": "id, order_id, sku_id, refund_amount",
    "refund_payment": "id, order_id, total_amount",
    "order_status_log": "id, order_id, order_status",
    "coupon_use": "id, coupon_id, order_id",
    "favor_info": "id, user_id, sku_id",
    "comment_info": "id, user_id, sku_id",
}

ALL_CHANGES = ("changes AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS tbl, k, id, sec FROM ({rows})" for name, rows in CHANGE_ROWS.items())
    + ")")

VERDICT = """CASE WHEN k % 101 BETWEEN 0 AND 4 THEN 'dirty' WHEN k % 97 = 0 THEN 'delete'
  ELSE 'pass' END"""
REASON = """CASE k % 101 WHEN 1 THEN 'no id' WHEN 2 THEN 'no table or op' WHEN 3 THEN 'unknown op'
  WHEN 4 THEN 'no after' END"""
ROUTE = ("CASE tbl " + " ".join(f"WHEN '{t}' THEN '{r}'" for t, r in ROUTES.items()) + " END")
OP = "CASE WHEN k % 10 = 0 THEN 'r' WHEN k % 10 = 1 THEN 'u' ELSE 'c' END"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def dwd_table(name: str) -> str:
    return f"""{_with(FEED, EVENTS)}
SELECT {DWD_COLUMNS[name]}, '{name}' AS _source_table, {OP} AS _op, sec * 1000 AS _ts_ms
FROM ({CHANGE_ROWS[name]}) WHERE {VERDICT} = 'pass'"""


# ---------------------------------------------------------------- logs

LOG_OK = "e % 101 <> 0 AND e % 103 NOT IN (0, 1, 2, 3) AND NOT (e % 103 = 4 AND kind <> 'signup')"
MID = "'mid_' || CAST(user_id AS VARCHAR)"
SID = ("CASE WHEN e % 11 <> 0 THEN 'sid_' || CAST(user_id AS VARCHAR) || '_' || "
       "CAST(e % 5 AS VARCHAR) END")
PAGE_ID = "CASE WHEN kind <> 'signup' THEN 'page_' || CAST(e % 20 AS VARCHAR) END"
LOG_KEYS = (f"{MID} AS mid, {SID} AS sid, "
            "CASE WHEN e % 103 = 5 THEN 9223372036854775807 ELSE sec * 1000 END AS ts")

LOG_QUERIES = {
    "dwd_page_log": f"SELECT {PAGE_ID} AS page_id, CAST(e % 3000 AS VARCHAR) AS during_time, "
                    f"{LOG_KEYS} FROM ev WHERE {LOG_OK} AND kind <> 'signup'",
    "dwd_start_log": f"SELECT 'icon' AS entry, CAST(e % 1000 AS VARCHAR) AS loading_time, "
                     f"{LOG_KEYS} FROM ev WHERE {LOG_OK} AND (kind = 'signup' OR e % 10 = 0)",
    "dwd_display_log": f"SELECT 'item_' || CAST(e % 50 AS VARCHAR) AS item, "
                       f"CAST(i AS VARCHAR) AS pos_id, {PAGE_ID} AS page_id, {LOG_KEYS} "
                       f"FROM ev, range(1, 4) AS r(i) WHERE {LOG_OK} AND kind = 'view' "
                       "AND i <= e % 4",
    "dwd_action_log": f"SELECT 'act_' || CAST(i AS VARCHAR) AS action_id, "
                      f"CAST(e % 50 AS VARCHAR) AS item, {PAGE_ID} AS page_id, {LOG_KEYS} "
                      f"FROM ev, range(1, 3) AS r(i) WHERE {LOG_OK} AND "
                      "i <= CASE kind WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END",
    "dwd_error_log": f"SELECT CAST(e % 500 AS VARCHAR) AS error_code, 'E' AS msg, "
                     f"{PAGE_ID} AS page_id, {LOG_KEYS} FROM ev WHERE {LOG_OK} AND kind = 'error'",
    "dwd_log_dirty": f"""SELECT CAST(e AS VARCHAR) AS seq, CASE WHEN e % 103 = 1 THEN 'no common'
      WHEN e % 103 = 2 THEN 'no ts' WHEN e % 103 = 0 THEN 'no mid'
      WHEN e % 103 = 3 THEN 'neither page nor start'
      WHEN e % 10 <> 0 OR e % 103 = 4 THEN 'bad nested value' END AS reason
      FROM ev WHERE e % 101 <> 0 AND NOT ({LOG_OK})""",
}

# ---------------------------------------------------------------- fact

DETAIL_REASON = """CASE WHEN trim(order_id) = '' OR trim(sku_id) = '' THEN 'missing key'
  WHEN NOT regexp_full_match(sku_num, '[+-]?[0-9]+') THEN 'bad sku_num'
  WHEN split_total_amount = 'abc' THEN 'bad amount' END"""
ORDER_REASON = "CASE WHEN original_total_amount = 'x1' THEN 'bad amount' END"
PROMO_REASON = "CASE WHEN order_detail_id IS NULL OR trim(order_detail_id) = '' THEN 'missing key' END"

CLEAN = f"""
vdet AS (
  SELECT k, id, order_id, sku_id, sku_name, order_price, sku_num,
         CASE WHEN trim(split_total_amount) = '' THEN '0' ELSE split_total_amount END
           AS split_total_amount,
         CASE WHEN trim(split_activity_amount) = '' THEN '0' ELSE split_activity_amount END
           AS split_activity_amount,
         CASE WHEN trim(split_coupon_amount) = '' THEN '0' ELSE split_coupon_amount END
           AS split_coupon_amount,
         create_time, sec, arr, seq FROM det WHERE {DETAIL_REASON} IS NULL),
vord AS (
  SELECT k, id, user_id, province_id, order_status, payment_way,
         CASE WHEN trim(original_total_amount) = '' THEN '0' ELSE original_total_amount END
           AS original_total_amount, sec, arr, seq FROM ord WHERE {ORDER_REASON} IS NULL),
vact AS (SELECT * FROM act WHERE {PROMO_REASON} IS NULL),
vcou AS (SELECT * FROM cou WHERE {PROMO_REASON} IS NULL)"""


def settled(feed: str = FEED, activity: bool = True, coupon: bool = True) -> str:
    """CTEs up to ``fact`` (settled, one row per detail)."""
    def newest(rows: str, key: str) -> str:
        return (f"SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {key} "
                "ORDER BY arr DESC, seq DESC) = 1")

    joins, last = "", "d.arr, o.arr"
    a_cols = "CAST(NULL AS VARCHAR) AS activity_id, CAST(NULL AS VARCHAR) AS activity_rule_id"
    c_cols = "CAST(NULL AS VARCHAR) AS coupon_id, CAST(NULL AS VARCHAR) AS coupon_use_id"
    if activity:
        joins += " LEFT JOIN la a ON a.order_detail_id = d.id"
        a_cols = "a.activity_id, a.activity_rule_id"
        last += ", a.arr"
    if coupon:
        joins += " LEFT JOIN lc c ON c.order_detail_id = d.id"
        c_cols = "c.coupon_id, c.coupon_use_id"
        last += ", c.arr"
    return _with(feed, CLEAN, f"""
ld AS ({newest('vdet', 'id')}), lo AS ({newest('vord', 'id')}),
la AS ({newest('vact', 'order_detail_id')}), lc AS ({newest('vcou', 'order_detail_id')}),
fact AS (
  SELECT d.id, d.order_id, d.sku_id, d.sku_name, d.order_price, d.sku_num, d.split_total_amount,
         d.split_activity_amount, d.split_coupon_amount, d.create_time, o.user_id, o.province_id,
         o.order_status, o.payment_way, o.original_total_amount, {a_cols}, {c_cols},
         'order_detail' AS _fact_type, ({T0} + greatest({last})) * 1000 AS _join_ts
  FROM ld d JOIN lo o ON d.order_id = o.id{joins})""")


FACT_COLUMNS = """id, order_id, sku_id, sku_name, order_price, sku_num, split_total_amount,
  split_activity_amount, split_coupon_amount, create_time, user_id, province_id, order_status,
  payment_way, original_total_amount, activity_id, activity_rule_id, coupon_id, coupon_use_id,
  _fact_type, _join_ts"""

TTL = 1800


def _changelog(name: str, left: str, right: str, emit_alone: bool) -> str:
    """CTE ``name``: emissions with columns key, arr, seq, l, r."""
    keep = f"l.arr IS NOT NULL AND arr - l.arr < {TTL}"
    if not emit_alone:
        keep += f" AND r.arr IS NOT NULL AND arr - r.arr < {TTL}"
    return f"""
{name}_e AS (
  SELECT key, 0 AS side, arr, seq, struct_pack(arr := arr, v := v) AS lw, NULL AS rw FROM ({left})
  UNION ALL
  SELECT key, 1, arr, seq, NULL, struct_pack(arr := arr, v := v) FROM ({right})),
{name}_k AS (
  SELECT key, side, arr, seq,
         last_value(lw IGNORE NULLS) OVER w AS l, last_value(rw IGNORE NULLS) OVER w AS r
  FROM {name}_e
  WINDOW w AS (PARTITION BY key ORDER BY arr, side, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name} AS (
  SELECT key, arr, CAST(side AS VARCHAR) || '|' || seq AS seq, l.v AS l,
         CASE WHEN arr - r.arr < {TTL} THEN r.v END AS r
  FROM {name}_k WHERE {keep})"""


def _pack(columns: list[str]) -> str:
    return "struct_pack(" + ", ".join(f"{c} := {c}" for c in columns) + ")"


D = ["id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "split_total_amount",
     "split_activity_amount", "split_coupon_amount", "create_time"]
O = ["user_id", "province_id", "order_status", "payment_way", "original_total_amount"]
A = ["activity_id", "activity_rule_id"]
C = ["coupon_id", "coupon_use_id"]
F_ALL = D + O + A + C


def changelog(upto: str = "coupon", feed: str = FEED) -> str:
    """CTEs up to ``fact`` (changelog)."""
    base = _changelog(
        "j1", f"SELECT order_id AS key, arr, seq, {_pack(D)} AS v FROM vdet",
        f"SELECT id AS key, arr, seq, {_pack(O)} AS v FROM vord", False)
    ctes = [feed, CLEAN, base, "f1 AS (SELECT arr, seq, " + ", ".join(
        [f"l.{c} AS {c}" for c in D] + [f"r.{c} AS {c}" for c in O]
        + [f"CAST(NULL AS VARCHAR) AS {c}" for c in A + C]) + " FROM j1)"]
    last = "f1"
    for level, (name, rows, fields) in enumerate(
            (("activity", "vact", A), ("coupon", "vcou", C)), start=2):
        if upto == "base":
            break
        ctes.append(_changelog(
            f"j{level}", f"SELECT id AS key, arr, seq, {_pack(F_ALL)} AS v FROM {last}",
            f"SELECT order_detail_id AS key, arr, seq, {_pack(fields)} AS v FROM {rows}", True))
        last = f"f{level}"
        ctes.append(f"{last} AS (SELECT arr, seq, " + ", ".join(
            f"CASE WHEN r IS NULL THEN l.{c} ELSE r.{c} END AS {c}" if c in fields
            else f"l.{c} AS {c}" for c in F_ALL) + f" FROM j{level})")
        if upto == name:
            break
    ctes.append("fact AS (SELECT " + ", ".join(F_ALL) + f", 'order_detail' AS _fact_type, "
                f"({T0} + arr) * 1000 AS _join_ts FROM {last})")
    return _with(*ctes)


FACT_SELECT = f"SELECT {FACT_COLUMNS} FROM fact"

FACT_DIRTY = f"""
SELECT 'fact_order_detail' AS stage, {DETAIL_REASON} AS reason, id AS row_id, k FROM det
UNION ALL SELECT 'fact_order_info', {ORDER_REASON}, id, k FROM ord
UNION ALL SELECT 'fact_order_detail_activity', {PROMO_REASON}, id, k FROM act
UNION ALL SELECT 'fact_order_detail_coupon', {PROMO_REASON}, id, k FROM cou"""

# ---------------------------------------------------------------- window tables

AMOUNT = ("CASE WHEN trim(split_total_amount) = '' THEN CAST(0 AS DECIMAL(28,6)) "
          "ELSE CAST(split_total_amount AS DECIMAL(28,6)) END")
IN_RANGE = f"abs(CAST(split_total_amount AS DOUBLE)) < 1e14"
SEC_OF_FACT = "epoch(strptime(create_time, '%Y-%m-%d %H:%M:%S'))"
WSTART = f"(CAST(floor({SEC_OF_FACT} / 30) AS BIGINT) * 30)"

SKU_WINDOW = f"""
sku_w AS (
  SELECT sku_id, w, first(sku_name ORDER BY _join_ts, id) FILTER (WHERE trim(sku_name) <> '')
           AS sku_name,
         CAST(round(sum(amount), 2) AS DECIMAL(16,2)) AS order_amount, count(*) AS order_count,
         CAST(sum(num) AS BIGINT) AS sku_num
  FROM (SELECT *, {WSTART} AS w, {AMOUNT} AS amount, CAST(sku_num AS BIGINT) AS num FROM fact
        WHERE {IN_RANGE})
  GROUP BY sku_id, w),
sku AS (SELECT sku_id, {ts('w')} AS stt, {ts('w + 30')} AS edt, sku_name, {day('w')} AS cur_date,
               order_amount, order_count, sku_num, w FROM sku_w)"""

PROVINCE_WINDOW = f"""
prov_w AS (
  SELECT province_id, w, CAST(round(sum(amount), 2) AS DECIMAL(16,2)) AS order_amount,
         count(*) AS order_count, CAST(sum(num) AS BIGINT) AS sku_num
  FROM (SELECT *, {WSTART} AS w, {AMOUNT} AS amount, CAST(sku_num AS BIGINT) AS num FROM fact
        WHERE {IN_RANGE})
  GROUP BY province_id, w),
prov AS (SELECT province_id, {ts('w')} AS stt, {ts('w + 30')} AS edt, {day('w')} AS cur_date,
                order_amount, order_count, sku_num, w FROM prov_w)"""

VIEWS_CTE = f"""
views AS (SELECT {MID} AS mid, {SID} AS sid, sec FROM ev
          WHERE {LOG_OK} AND kind <> 'signup' AND e % 103 <> 5)"""
TRAFFIC_WINDOW = f"""
traf_w AS (SELECT (sec // 30) * 30 AS w, count(*) AS pv_ct, count(DISTINCT mid) AS uv_ct,
                  count(DISTINCT sid) AS sv_ct FROM views GROUP BY 1),
traf AS (SELECT {ts('w')} AS stt, {ts('w + 30')} AS edt, {day('w')} AS cur_date,
                pv_ct, uv_ct, sv_ct, w FROM traf_w)"""

SKU = settled() + "," + SKU_WINDOW
PROVINCE = settled() + "," + PROVINCE_WINDOW
TRAFFIC = _with(EVENTS, VIEWS_CTE, TRAFFIC_WINDOW)

SKU_SELECT = ("SELECT sku_id, stt, edt, sku_name, cur_date, CAST(order_amount AS DOUBLE) "
              "AS order_amount, order_count, sku_num FROM sku")
PROVINCE_SELECT = ("SELECT province_id, stt, edt, cur_date, CAST(order_amount AS DOUBLE) "
                   "AS order_amount, order_count, sku_num FROM prov")
TRAFFIC_SELECT = "SELECT stt, edt, cur_date, pv_ct, uv_ct, sv_ct FROM traf"


def today(rows: str) -> str:
    return f"{rows} WHERE cur_date = (SELECT max(cur_date) FROM {rows})"


def trade(amount: str, count: str) -> str:
    return (f"CAST(sum(order_amount) AS DOUBLE) AS {amount}, CAST(sum(order_count) AS BIGINT) AS "
            f"{count}, CAST(sum(sku_num) AS BIGINT) AS sku_num")


TRAFFIC_SUMS = ("CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, "
                "CAST(sum(sv_ct) AS BIGINT) AS sv_ct")
HOUR = "substr(stt, 12, 2) || ':00:00' AS hour_time"
SKUS = "count(DISTINCT sku_id) AS ordered_sku_count"

SKU_RANK = f"""{SKU}
SELECT *, row_number() OVER (ORDER BY order_amount DESC, sku_id) AS rn FROM (
  SELECT cur_date, sku_id, max(sku_name) AS sku_name, {trade('order_amount', 'sku_order_count')}
  FROM {today('sku')} GROUP BY cur_date, sku_id)"""
PROVINCE_RANK = f"""{PROVINCE}
SELECT *, row_number() OVER (ORDER BY gmv DESC, province_id) AS rn FROM (
  SELECT cur_date, province_id, {trade('gmv', 'province_order_count')}
  FROM {today('prov')} GROUP BY cur_date, province_id)"""

ADS = {
    "ads_trade_stats_today": f"{SKU} SELECT cur_date, {trade('gmv', 'sku_order_count')}, {SKUS}, "
                             f"max(edt) AS latest_window_time FROM {today('sku')} GROUP BY cur_date",
    "ads_trade_sku_order_topn_today": SKU_RANK,
    "ads_trade_trend_30s": f"{SKU} SELECT stt, edt, cur_date, {trade('gmv', 'sku_order_count')}, "
                           f"{SKUS} FROM {today('sku')} GROUP BY stt, edt, cur_date",
    "ads_trade_hour_stats_today": f"{SKU} SELECT cur_date, {HOUR}, "
                                  f"{trade('gmv', 'sku_order_count')}, {SKUS} "
                                  f"FROM {today('sku')} GROUP BY cur_date, hour_time",
    "ads_trade_province_order_today": f"{PROVINCE} SELECT cur_date, province_id, "
                                      f"{trade('gmv', 'province_order_count')}, max(edt) AS "
                                      f"latest_window_time FROM {today('prov')} "
                                      "GROUP BY cur_date, province_id",
    "ads_trade_province_order_topn_today": PROVINCE_RANK,
    "ads_traffic_stats_today": f"{TRAFFIC} SELECT cur_date, {TRAFFIC_SUMS}, max(edt) AS "
                               f"latest_window_time FROM {today('traf')} GROUP BY cur_date",
    "ads_traffic_page_view_trend_30s": f"{TRAFFIC} SELECT stt, edt, cur_date, {TRAFFIC_SUMS} "
                                       f"FROM {today('traf')} GROUP BY stt, edt, cur_date",
    "ads_traffic_hour_stats_today": f"{TRAFFIC} SELECT cur_date, {HOUR}, {TRAFFIC_SUMS} "
                                    f"FROM {today('traf')} GROUP BY cur_date, hour_time",
}

BOTH = settled() + "," + SKU_WINDOW + "," + EVENTS + "," + VIEWS_CTE + "," + TRAFFIC_WINDOW

SUMMARY = f"""{BOTH},
t AS (SELECT cur_date, {trade('gmv', 'sku_order_count')}, {SKUS}, max(edt) AS w
      FROM {today('sku')} GROUP BY cur_date),
v AS (SELECT cur_date, {TRAFFIC_SUMS}, max(edt) AS w FROM {today('traf')} GROUP BY cur_date)
SELECT t.cur_date AS trade_cur_date, t.gmv AS trade_gmv, t.sku_order_count AS trade_sku_order_count,
       t.sku_num AS trade_sku_num, t.ordered_sku_count AS trade_ordered_sku_count,
       t.w AS trade_latest_window_time, v.cur_date AS traffic_cur_date, v.pv_ct AS traffic_pv_ct,
       v.uv_ct AS traffic_uv_ct, v.sv_ct AS traffic_sv_ct, v.w AS traffic_latest_window_time,
       coalesce(t.cur_date, v.cur_date) AS cur_date, greatest(t.w, v.w) AS latest_window_time
FROM t FULL JOIN v ON TRUE"""

# ---------------------------------------------------------------- dimensions

CONFIG = f"""
cfg_raw(s, op, source_table, sink_table, sink_family, sink_row_key, sink_columns, sink_type) AS (
  VALUES
    (0, 'r', 'user_info', 'dim_user_info', NULL, NULL, 'name, nation', 'dim'),
    (0, 'r', 'sku_info', 'dim_sku_info', 'cf', ' ', NULL, NULL),
    (1000, 'c', 'base_province', 'dim_base_province', 'info', 'id', 'name,,region ', 'DIM'),
    (1500, 'u', 'user_info', 'dim_user_info', 'info', 'id', 'name,nation,balance', 'dim'),
    (2000, 'd', 'sku_info', 'dim_sku_info', 'cf', NULL, NULL, 'dim'),
    (2500, 'u', 'base_province', 'dim_base_province', 'info', 'id', 'name', 'dwd'),
    (3000, 'c', 'sku_info', 'dim_sku_info', 'cf', 'id', 'name,brand', 'dim'),
    (3500, 'u', 'base_province', 'dim_base_province', 'info', 'id', NULL, 'dim')),
cfg AS (
  SELECT s, source_table, sink_table,
         coalesce(nullif(trim(sink_family), ''), 'info') AS sink_family,
         coalesce(nullif(trim(sink_row_key), ''), 'id') AS sink_row_key,
         [trim(x) FOR x IN string_split(sink_columns, ',') IF trim(x) <> ''] AS sink_columns,
         coalesce(nullif(trim(sink_type), ''), 'dim') AS sink_type,
         CASE WHEN op = 'd' OR lower(coalesce(nullif(trim(sink_type), ''), 'dim')) <> 'dim'
           THEN 'remove' ELSE 'put' END AS action
  FROM cfg_raw),
per AS (
  SELECT * FROM (
    SELECT *, coalesce(lead(s) OVER (PARTITION BY source_table ORDER BY s), 1000000000) AS until
    FROM cfg) WHERE action = 'put')"""

DIM_FEED = """
ver(v) AS (VALUES (1), (2), (3), (4)),
dim_rows AS (
  SELECT * FROM (
    SELECT 'user_info' AS source_table, c_custkey AS k, c_name AS a,
           CAST(c_nationkey AS VARCHAR) AS b, CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR) AS z,
           'name' AS an, 'nation' AS bn, 'balance' AS zn FROM customer
    UNION ALL
    SELECT 'sku_info', p_partkey, p_name, CAST(p_size AS VARCHAR), p_brand, 'name', 'size', 'brand'
    FROM part
    UNION ALL
    SELECT 'base_province', n_nationkey, n_name, CAST(n_regionkey + 1 AS VARCHAR),
           CAST(n_regionkey AS VARCHAR), 'name', 'zone', 'region' FROM nation) r, ver
  WHERE v = 1 OR (v = 2 AND k % 7 = 0) OR (v = 3 AND k % 13 = 0) OR (v = 4 AND k % 26 = 0)),
dim_ev AS (
  SELECT source_table, k, v, (k * 37) % 2400 + v * 600 AS arr, an, bn, zn,
         CASE WHEN v = 1 THEN a ELSE a || '#' || CAST(v AS VARCHAR) END AS a, b,
         CASE WHEN v <> 2 THEN z END AS z,
         CASE v WHEN 2 THEN 'u' WHEN 3 THEN 'd' ELSE 'c' END AS op
  FROM dim_rows),
conf AS (
  SELECT d.*, p.sink_table, p.sink_family, p.sink_row_key, p.sink_columns
  FROM dim_ev d JOIN per p ON d.source_table = p.source_table AND d.arr >= p.s AND d.arr < p.until),
cells AS (
  SELECT sink_table, CAST(k AS VARCHAR) AS row_key, sink_family AS family, col, cell, arr, v FROM (
    SELECT *, an AS col, a AS cell FROM conf UNION ALL SELECT *, bn, b FROM conf
    UNION ALL SELECT *, zn, z FROM conf)
  WHERE op <> 'd' AND cell IS NOT NULL
    AND (sink_columns IS NULL OR list_contains(sink_columns, col)))"""

DIM = _with(CONFIG, DIM_FEED)

# ---------------------------------------------------------------- all statements


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["ods_json_gate"] = f"""{_with(FEED, EVENTS, ALL_CHANGES)}
SELECT feed, status, count(*) AS n FROM (
  SELECT 'db' AS feed, CASE WHEN k % 101 = 0 THEN 'dirty' ELSE 'pass' END AS status FROM changes
  UNION ALL SELECT 'log', CASE WHEN e % 101 = 0 THEN 'dirty' ELSE 'pass' END FROM ev)
GROUP BY feed, status"""
    sql["ods_dirty_rows"] = f"""{_with(FEED, EVENTS, ALL_CHANGES)}
SELECT 'ods_db' AS stage, '{{"op":"c","source":{{"table":"' || tbl || '"}},"after":{{"id":"' || id
       || '"' AS value, 'not a JSON object' AS reason FROM changes WHERE k % 101 = 0
UNION ALL SELECT 'ods_log', '{{"common":{{"mid":"' || CAST(e AS VARCHAR), 'not a JSON object'
FROM ev WHERE e % 101 = 0"""
    sql["dwd_cdc_validity"] = f"""{_with(FEED, EVENTS, ALL_CHANGES)}
SELECT tbl AS source_table, {VERDICT} AS verdict,
       CASE WHEN k % 101 BETWEEN 1 AND 4 THEN {REASON} END AS reason, count(*) AS n
FROM changes WHERE k % 101 <> 0 GROUP BY ALL"""
    sql["dwd_db_split_counts"] = f"""{_with(FEED, EVENTS, ALL_CHANGES)}
SELECT CASE {VERDICT} WHEN 'dirty' THEN 'dirty_data' WHEN 'pass' THEN {ROUTE} END AS route,
       count(*) AS n FROM changes WHERE k % 101 <> 0 GROUP BY ALL"""
    for table, stream in ROUTES.items():
        sql[stream] = dwd_table(table)
    for name, text in LOG_QUERIES.items():
        sql[name] = f"{_with(EVENTS)} {text}"
    # sent-on text, numbers as they were spelled
    sql["dwd_order_status_text"] = f"""{_with(FEED, EVENTS)}
SELECT '{{"id":"' || id || '","order_id":"' || order_id || '","order_status":"' || order_status
       || '","weight":' || CAST(k AS VARCHAR) || '000000000000000000.00,"_source_table":"order_status_log","_op":"'
       || {OP} || '","_ts_ms":' || CAST(sec * 1000 AS VARCHAR) || '}}' AS value
FROM ({CHANGE_ROWS["order_status_log"]}) WHERE {VERDICT} = 'pass'"""
    sql["dwd_display_text"] = f"""{_with(EVENTS)}
SELECT '{{"item":"' || item || '","pos_id":' || pos_id || ',"common":{{"mid":"' || mid || '"'
       || coalesce(',"sid":"' || sid || '"', '') || '}},"page":{{"page_id":"' || page_id || '","during_time":'
       || CAST(e % 3000 AS VARCHAR) || '}},"ts":' || CAST(ts AS VARCHAR) || '}}' AS value
FROM ({LOG_QUERIES["dwd_display_log"].replace("SELECT ", "SELECT e, ", 1)})"""
    for kind, own in (("action", """'{{"action_id":"' || action_id || '","item":' || item"""),
                      ("error", """'{{"error_code":' || error_code || ',"msg":"' || msg || '"'""")):
        own = own.replace("{{", "{")
        sql[f"dwd_{kind}_text"] = f"""{_with(EVENTS)}
SELECT {own} || ',"common":{{"mid":"' || mid || '"' || coalesce(',"sid":"' || sid || '"', '') || '}}'
       || CASE WHEN page_id IS NOT NULL THEN ',"page":{{"page_id":"' || page_id || '","during_time":'
               || CAST(e % 3000 AS VARCHAR) || '}}' ELSE '' END
       || ',"ts":' || CAST(ts AS VARCHAR) || '}}' AS value
FROM ({LOG_QUERIES[f"dwd_{kind}_log"].replace("SELECT ", "SELECT e, ", 1)})"""
    sql["dwd_log_split_counts"] = f"{_with(EVENTS)} SELECT route, count(*) AS n FROM (" + \
        " UNION ALL ".join(
            f"SELECT '{r}' AS route FROM ({LOG_QUERIES[q]})" for q, r in (
                ("dwd_page_log", "dwd_traffic_page_log"),
                ("dwd_start_log", "dwd_traffic_start_log"),
                ("dwd_display_log", "dwd_traffic_display_log"),
                ("dwd_action_log", "dwd_traffic_action_log"),
                ("dwd_error_log", "dwd_traffic_error_log"),
                ("dwd_log_dirty", "dirty_data"))) + ") GROUP BY route"

    sql["fact_detail_validity"] = f"""{_with(FEED)}
SELECT {DETAIL_REASON} AS reason, count(*) AS n, sum(k)::BIGINT AS keys FROM det GROUP BY 1"""
    sql["fact_order_validity"] = f"""{_with(FEED)}
SELECT {ORDER_REASON} AS reason, count(*) AS n, sum(k)::BIGINT AS keys FROM ord GROUP BY 1"""
    sql["fact_promotion_validity"] = f"""{_with(FEED)}
SELECT 'activity' AS side, {PROMO_REASON} AS reason, count(*) AS n FROM act GROUP BY 1, 2
UNION ALL SELECT 'coupon', {PROMO_REASON}, count(*) FROM cou GROUP BY 1, 2"""
    sql["fact_base_settled"] = settled(activity=False, coupon=False) + FACT_SELECT
    sql["fact_activity"] = settled(coupon=False) + FACT_SELECT
    sql["fact_coupon"] = settled(activity=False) + FACT_SELECT
    sql["fact_settled"] = settled() + FACT_SELECT
    sql["fact_base_changelog"] = changelog("base") + FACT_SELECT
    sql["fact_activity_changelog"] = changelog("activity") + FACT_SELECT
    sql["fact_changelog"] = changelog("coupon") + FACT_SELECT
    sql["fact_dirty_union"] = f"""{_with(FEED, EVENTS)}
SELECT stage, reason, count(*) AS n FROM (
  SELECT 'ods_db' AS stage, 'not a JSON object' AS reason FROM changes WHERE k % 101 = 0
  UNION ALL SELECT 'dwd_split', {REASON} FROM changes WHERE k % 101 BETWEEN 1 AND 4
  UNION ALL SELECT stage, reason FROM ({FACT_DIRTY})
  WHERE reason IS NOT NULL AND {VERDICT} = 'pass') GROUP BY stage, reason""".replace(
        "\nSELECT stage, reason, count", ",\nchanges AS (" + " UNION ALL ".join(
            f"SELECT '{n}' AS tbl, k FROM ({CHANGE_ROWS[n]})" for n in
            ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon",
             "payment_info", "refund_payment", "order_status_log", "order_refund_info",
             "coupon_use")) + ")\nSELECT stage, reason, count", 1)

    sql["sku_fact_parse"] = f"""{settled()}
SELECT id, sku_id, {SEC_OF_FACT}::BIGINT AS event_second, CAST({AMOUNT} AS DOUBLE) AS amount,
       CAST(sku_num AS BIGINT) AS num FROM fact WHERE {IN_RANGE}"""
    sql["province_fact_parse"] = f"""{settled()}
SELECT id, province_id, {SEC_OF_FACT}::BIGINT AS event_second, CAST({AMOUNT} AS DOUBLE) AS amount,
       CAST(sku_num AS BIGINT) AS num FROM fact WHERE {IN_RANGE}"""
    for side in ("sku", "province"):
        sql[f"{side}_fact_dirty"] = f"""{settled()}
SELECT 'dws_trade_{side}' AS stage, 'bad amount' AS reason, id FROM fact WHERE NOT ({IN_RANGE})"""
    sql["page_view_dirty"] = f"""{_with(EVENTS)}
SELECT 'dws_traffic' AS stage, 'bad ts' AS reason, CAST(e AS VARCHAR) AS seq FROM ev
WHERE {LOG_OK} AND kind <> 'signup' AND e % 103 = 5"""
    sql["e2e_fact_settled"] = settled(E2E_FEED) + FACT_SELECT
    sql["e2e_sku_topn"] = f"""{settled(E2E_FEED)},{SKU_WINDOW}
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY order_amount DESC, sku_id) AS rn FROM (
  SELECT cur_date, sku_id, max(sku_name) AS sku_name, {trade('order_amount', 'sku_order_count')}
  FROM sku WHERE cur_date = (SELECT max(cur_date) FROM sku) GROUP BY cur_date, sku_id)) WHERE rn <= 10"""
    sql["e2e_dirty"] = f"""WITH a AS ({sql["fact_dirty_union"]}),
b AS ({settled(E2E_FEED)} SELECT count(*) AS n FROM fact WHERE NOT ({IN_RANGE}))
SELECT stage, reason, n FROM a
UNION ALL SELECT 'dws_trade_sku', 'bad amount', n FROM b
UNION ALL SELECT 'dws_trade_province', 'bad amount', n FROM b"""
    sql["page_view_parse"] = f"{_with(EVENTS, VIEWS_CTE)} SELECT mid, sid, sec AS event_second FROM views"
    sql["dws_sku_window"] = SKU + SKU_SELECT
    sql["dws_province_window"] = PROVINCE + PROVINCE_SELECT
    sql["dws_traffic_window"] = TRAFFIC + TRAFFIC_SELECT
    for key, rows, text in (("sku", "sku", SKU), ("province", "prov", PROVINCE)):
        sql[f"dws_{key}_daily_totals"] = text + f"""
SELECT cur_date, {key}_id, {trade('order_amount', 'order_count')} FROM {rows} GROUP BY cur_date, {key}_id"""
    sql["dws_province_window_changelog"] = changelog() + "," + PROVINCE_WINDOW + PROVINCE_SELECT
    sql["dws_sku_latest20"] = SKU + f"{SKU_SELECT} ORDER BY stt DESC, sku_id LIMIT 20"
    sql["dws_province_latest20"] = PROVINCE + f"{PROVINCE_SELECT} ORDER BY stt DESC, province_id LIMIT 20"
    sql["dws_traffic_latest20"] = TRAFFIC + f"{TRAFFIC_SELECT} ORDER BY stt DESC LIMIT 20"
    money = "CAST(order_amount AS VARCHAR)"
    sql["dws_sku_tsv_export"] = SKU + f"""
SELECT concat(sku_id, chr(9), stt, chr(9), edt, chr(9), coalesce(sku_name, ''), chr(9), cur_date,
              chr(9), {money}, chr(9), order_count, chr(9), sku_num) AS line FROM sku"""
    sql["dws_province_tsv_export"] = PROVINCE + f"""
SELECT concat(province_id, chr(9), stt, chr(9), edt, chr(9), cur_date, chr(9), {money}, chr(9),
              order_count, chr(9), sku_num) AS line FROM prov"""
    sql["dws_traffic_tsv_export"] = TRAFFIC + """
SELECT concat(stt, chr(9), edt, chr(9), cur_date, chr(9), pv_ct, chr(9), uv_ct, chr(9), sv_ct)
  AS line FROM traf"""

    sql.update(ADS)
    sql["dash_summary"] = SUMMARY
    sql["dash_trade_trend"] = ADS["ads_trade_trend_30s"]
    sql["dash_traffic_trend"] = ADS["ads_traffic_page_view_trend_30s"]
    sql["dash_sku_topn"] = f"SELECT * FROM ({SKU_RANK}) WHERE rn <= 10"
    sql["dash_province_topn"] = f"SELECT * FROM ({PROVINCE_RANK}) WHERE rn <= 10"
    sql["dash_hour_trade"] = ADS["ads_trade_hour_stats_today"]
    sql["dash_hour_traffic"] = ADS["ads_traffic_hour_stats_today"]

    sql["dim_config_parse"] = f"""{DIM}
SELECT c.source_table, c.sink_table, c.sink_family, c.sink_row_key,
       array_to_string(c.sink_columns, ',') AS sink_columns, c.sink_type, c.action,
       c.s AS second, count(d.k) AS rows_of_table
FROM cfg c LEFT JOIN dim_ev d ON d.source_table = c.source_table
GROUP BY ALL"""
    sql["dim_config_asof"] = f"""{DIM}
SELECT source_table, CAST(k AS VARCHAR) AS row_id, op, sink_table, sink_family,
       array_to_string(sink_columns, ',') AS sink_columns, arr AS second FROM conf"""
    sql["dim_project"] = f"""{DIM}
SELECT sink_table, row_key, family, col AS "column", cell, arr AS second FROM cells
UNION ALL SELECT sink_table, CAST(k AS VARCHAR), sink_family, NULL, NULL, arr FROM conf WHERE op = 'd'"""
    snapshot = f"""{DIM},
gone AS (SELECT sink_table, CAST(k AS VARCHAR) AS row_key, max(arr) AS arr FROM conf
         WHERE op = 'd' GROUP BY 1, 2),
now AS (SELECT c.* FROM cells c LEFT JOIN gone g USING (sink_table, row_key)
        WHERE g.arr IS NULL OR c.arr > g.arr
        QUALIFY row_number() OVER (PARTITION BY sink_table, row_key, family, col
                                   ORDER BY c.arr DESC, c.v DESC) = 1)"""
    sql["dim_snapshot"] = f"""{snapshot}
SELECT sink_table, row_key, family, col AS "column", cell, arr AS second FROM now"""
    sql["dim_user_info"] = f"""{snapshot}
SELECT row_key, max(cell) FILTER (WHERE col = 'name') AS name,
       max(cell) FILTER (WHERE col = 'nation') AS nation,
       max(cell) FILTER (WHERE col = 'balance') AS balance
FROM now WHERE sink_table = 'dim_user_info' GROUP BY row_key"""

    # streaming runs emit closed windows only: end + 3 s of the newest row
    closed_fact = f"(SELECT max({SEC_OF_FACT}) FROM fact WHERE {IN_RANGE}) - 3 >= w + 30"
    sql["stream_traffic_window"] = TRAFFIC + \
        f"{TRAFFIC_SELECT} WHERE (SELECT max(sec) FROM views) - 3 >= w + 30"
    sql["stream_sku_window"] = SKU + f"{SKU_SELECT} WHERE {closed_fact}"
    sql["stream_province_window"] = PROVINCE + f"{PROVINCE_SELECT} WHERE {closed_fact}"
    sql["stream_db_split"] = sql["dwd_db_split_counts"].replace(
        "FROM changes WHERE k % 101 <> 0 GROUP BY ALL",
        f"FROM changes WHERE k % 101 <> 0 AND ({VERDICT} = 'dirty' OR ({VERDICT} = 'pass' "
        f"AND {ROUTE} IS NOT NULL)) "
        "GROUP BY ALL")
    sql["stream_log_split"] = _stream_log_split()
    sql["stream_sku_outputs"] = SKU + f"""
SELECT 'dws_trade_sku_order_window' AS stage, cur_date || ' ' || substr(stt, 12, 8) AS reason, count(*) AS n
FROM ({SKU_SELECT} WHERE {closed_fact}) GROUP BY ALL
UNION ALL SELECT 'dws_trade_sku', 'bad amount', count(*) FROM fact WHERE NOT ({IN_RANGE}) HAVING count(*) > 0"""
    sql["stream_traffic_outputs"] = TRAFFIC + f"""
SELECT 'dws_traffic_page_view_window' AS stage, cur_date || ' ' || substr(stt, 12, 8) AS reason, count(*) AS n
FROM ({TRAFFIC_SELECT} WHERE (SELECT max(sec) FROM views) - 3 >= w + 30) GROUP BY ALL
UNION ALL SELECT 'dws_traffic_page_view', 'bad ts', count(*) FROM ev
WHERE {LOG_OK} AND kind <> 'signup' AND e % 103 = 5 HAVING count(*) > 0"""
    timed = f"""{_with(EVENTS)},
timed AS (SELECT {MID} AS mid, {SID} AS sid, sec, CAST(e AS VARCHAR) AS seq,
                 sec + ((e * 13) % 10) * ((e * 7) % 10) AS arr FROM ev
          WHERE {LOG_OK} AND kind <> 'signup' AND e % 103 <> 5),
marked AS (SELECT *, max(sec) OVER (ORDER BY arr, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3
                  AS watermark FROM timed),
judged AS (SELECT *, coalesce((sec // 30) * 30 + 30 <= watermark, false) AS late FROM marked)"""
    sql["dws_traffic_late_rows"] = f"""{timed}
SELECT seq, sec AS event_second, watermark AS watermark_second FROM judged WHERE late"""
    sql["dws_traffic_window_exact"] = f"""{timed},
views AS (SELECT * FROM judged WHERE NOT late),{TRAFFIC_WINDOW}
{TRAFFIC_SELECT}"""
    sql["ods_snapshot_handover"] = """WITH c AS (
  SELECT o_orderkey AS key, v, (o_orderkey * 7919) % 50000 + v * 20000 AS position,
         CASE WHEN v = 2 AND o_orderkey % 5 = 0 THEN 'd' WHEN v = 0 THEN 'c' ELSE 'u' END AS op,
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) || ' v' || v AS value,
         ((o_orderkey // 1000) * 1543) % 60000 + 15000 AS high
  FROM orders, range(0, 3) AS r(v)),
s AS (SELECT * FROM c WHERE position <= high
      QUALIFY row_number() OVER (PARTITION BY key ORDER BY position DESC) = 1)
SELECT key, 'r' AS op, high AS position, value FROM s WHERE op <> 'd'
UNION ALL SELECT key, op, position, value FROM c WHERE position > high"""
    sql["dim_snapshot_incremental"] = sql["dim_snapshot"]
    sql["stream_fact_base"] = sql["fact_base_changelog"]
    sql["stream_fact"] = sql["fact_changelog"]
    sql["stream_dim_snapshot"] = sql["dim_snapshot"]
    return sql


def _stream_log_split() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{r}' AS route FROM ({LOG_QUERIES[q]})" for q, r in (
            ("dwd_page_log", "dwd_traffic_page_log"), ("dwd_start_log", "dwd_traffic_start_log"),
            ("dwd_display_log", "dwd_traffic_display_log"),
            ("dwd_action_log", "dwd_traffic_action_log"),
            ("dwd_error_log", "dwd_traffic_error_log"), ("dwd_log_dirty", "dirty_data")))
    return (f"{_with(EVENTS)} SELECT route, count(*) AS n FROM ({counts} UNION ALL "
            "SELECT 'dirty_data' FROM ev WHERE e % 101 = 0) GROUP BY route")
