"""Rules that turn the given tables into warehouse inputs.

The rules are written as SQL expressions; the comparison SQL of the queries states
the same rules in its own dialect.  Every given table is scanned once per feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.sources.schemas import DWD_ROUTES

DAY_ONE = 1704067200  # 2024-01-01 00:00:00 UTC


class Tables:
    """The given tables; each is opened once per instance.

    With ``streaming`` the tables are streams of their files; ``lookup`` always gives
    the stored table, for joins to reference data.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, streaming: bool = False):
        self.spark, self.sf_dir, self.streaming = spark, sf_dir, streaming
        self._stored: dict[str, DataFrame] = {}
        self._streams: dict[str, DataFrame] = {}

    def lookup(self, name: str) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._stored[name]

    def __getitem__(self, name: str) -> DataFrame:
        if not self.streaming:
            return self.lookup(name)
        if name not in self._streams:
            # a pattern, because a stream takes a plain path for a folder
            path = f"{self.sf_dir}/{name}.parque[t]"
            self._streams[name] = (self.spark.readStream.schema(self.lookup(name).schema)
                                   .parquet(path))
        return self._streams[name]


def _arrival(seconds: str) -> str:
    return f"timestamp_seconds({DAY_ONE} + {seconds})"


def order_seconds(key: str) -> str:
    """Epoch second of an order: two days, three hours each."""
    return f"({DAY_ONE} + ({key} % 2) * 86400 + ({key} * 17) % 10800)"


PAGE_SECONDS = f"({DAY_ONE} + (event_id % 2) * 86400 + (event_id * 7) % 3600)"


def _raw_lines(t: Tables) -> DataFrame:
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
                                "l_returnflag", "l_linestatus")


def _named_lines(rows: DataFrame, *more: str) -> DataFrame:
    return rows.selectExpr(
        "l_orderkey AS o", "l_linenumber AS ln", "l_partkey", "l_suppkey",
        "l_orderkey * 100 + l_linenumber AS k",
        "CAST(l_quantity AS BIGINT) AS qty",
        "CAST(l_extendedprice AS DECIMAL(16,2)) AS price",
        "CAST(l_discount AS DECIMAL(4,2)) AS disc",
        "l_returnflag AS flag", "l_linestatus AS status",
        "concat_ws('|', l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(16,2)), "
        "CAST(l_quantity AS BIGINT), CAST(l_discount AS DECIMAL(4,2)), "
        "CAST(l_tax AS DECIMAL(4,2)), date_format(l_shipdate, 'yyyy-MM-dd'), l_returnflag, "
        "l_linestatus) AS seq", *more,
    ).selectExpr("*", "CAST(k AS STRING) AS id", f"{order_seconds('o')} * 1000 AS event_ms")


def _lines(t: Tables) -> DataFrame:
    return _named_lines(_raw_lines(t))


def _lines_with_parts(t: Tables) -> DataFrame:
    """The long text ``seq`` is made behind the join, which then shuffles numbers only."""
    parts = t.lookup("part").select("p_partkey", "p_name", "p_brand")
    lines = _raw_lines(t)
    return _named_lines(lines.join(parts, lines["l_partkey"] == parts["p_partkey"]),
                        "p_partkey", "p_name", "p_brand")


# fixed rules: remainders of the detail key k % 103 select damaged rows:
# 0 no order id, 1 bad count, 2 bad amount, 3 blank amount, 4 amount with exponent,
# 9 amount beyond what a window table holds, 7 blank activity key, 8 no coupon key; order key % 103: 5 bad total, 6 blank total
DETAIL_COLUMNS = [
    "id",
    "CASE WHEN k % 103 = 0 THEN '' ELSE CAST(o AS STRING) END AS order_id",
    "CAST(l_partkey AS STRING) AS sku_id",
    "CASE WHEN k % 5 = 0 THEN ' ' ELSE concat(p_name, ' v', ln % 3) END AS sku_name",
    "CAST(price AS STRING) AS order_price",
    "CASE WHEN k % 103 = 1 THEN '12.7' ELSE CAST(qty AS STRING) END AS sku_num",
    "CASE k % 103 WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN '1e3' WHEN 9 THEN '1e15' "
    "ELSE CAST(CAST(round(price * (1 - disc), 2) AS DECIMAL(16,2)) AS STRING) END "
    "AS split_total_amount",
    "CASE WHEN disc >= 0.05 THEN CAST(CAST(round(price * disc, 2) AS DECIMAL(16,2)) AS STRING) "
    "ELSE '' END AS split_activity_amount",
    "CASE WHEN flag = 'R' THEN '1.00' ELSE '' END AS split_coupon_amount",
    "date_format(timestamp_millis(event_ms), 'yyyy-MM-dd HH:mm:ss') AS create_time",
]
ACTIVITY_COLUMNS = [
    "id", "CASE WHEN k % 103 = 7 THEN '  ' ELSE id END AS order_detail_id",
    "p_brand AS activity_id", "CAST(l_partkey % 10 AS STRING) AS activity_rule_id"]
COUPON_COLUMNS = [
    "id", "CASE WHEN k % 103 <> 8 THEN id END AS order_detail_id",
    "CAST(l_suppkey AS STRING) AS coupon_id", "CAST(k + 5 AS STRING) AS coupon_use_id"]
ORDER_COLUMNS = [
    "id", "CAST(o_custkey AS STRING) AS user_id", "CAST(c_nationkey AS STRING) AS province_id",
    "o_orderstatus AS order_status", "o_orderpriority AS payment_way",
    "CASE k % 103 WHEN 5 THEN 'x1' WHEN 6 THEN ' ' ELSE total END AS original_total_amount"]

IS_ACTIVITY = "disc >= 0.05"
IS_COUPON = "flag = 'R'"


def _line_arrival(shift: int) -> str:
    return _arrival(f"(o * 31 + ln * 700 + {shift}) % 5000")


ORDER_ARRIVAL = _arrival("(k * 31 + 1200) % 5000")
PAGE_ARRIVAL = _arrival("(event_id * 7) % 3600")


def _typed(rows: DataFrame, columns: list[str], arrival: str) -> DataFrame:
    """Typed rows, computed once, like rows that were read from a stream."""
    return rows.selectExpr("seq", f"inline(array(struct({', '.join(columns)}, event_ms, "
                                  f"{arrival} AS arrival_ts)))")


def details(t: Tables) -> DataFrame:
    return _typed(_lines_with_parts(t), DETAIL_COLUMNS, _line_arrival(0))


def activities(t: Tables) -> DataFrame:
    return _typed(_lines_with_parts(t).filter(IS_ACTIVITY), ACTIVITY_COLUMNS, _line_arrival(900))


def coupons(t: Tables) -> DataFrame:
    return _typed(_lines(t).filter(IS_COUPON), COUPON_COLUMNS, _line_arrival(2500))


def as_detail_text(inputs: dict[str, DataFrame]) -> DataFrame:
    """Typed fact inputs (by table) as detail text under their routes."""
    found = None
    for table, rows in inputs.items():
        fields = [n for n in rows.columns if n not in ("arrival_ts", "seq")]
        text = rows.select(F.lit(DWD_ROUTES[table]).alias("route"), F.to_json(F.struct(*fields)).alias("value"),
                           "arrival_ts", "seq")
        found = text if found is None else found.unionByName(text)
    return found


def _orders(t: Tables) -> DataFrame:
    buyers = t.lookup("customer").select("c_custkey", "c_nationkey")
    rows = t["orders"].selectExpr(
        "o_orderkey AS k", "CAST(o_orderkey AS STRING) AS id", "o_custkey", "o_orderstatus",
        "o_orderpriority", "CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS STRING) AS total",
        f"{order_seconds('o_orderkey')} * 1000 AS event_ms", "'' AS seq")
    return rows.join(buyers, rows["o_custkey"] == buyers["c_custkey"])


def orders(t: Tables) -> DataFrame:
    return _typed(_orders(t), ORDER_COLUMNS, ORDER_ARRIVAL)


def _entry(table: str, condition: str, columns: list[str], arrival: str) -> tuple[str, ...]:
    """One possible change of a source row; the id is blank where change key % 101 = 1."""
    body = ["CASE WHEN k % 101 = 1 THEN ' ' ELSE id END AS id"] + columns[1:]
    return table, condition, f"to_json(struct({', '.join(body)}))", arrival


def _changes(rows: DataFrame, *entries: tuple[str, ...]) -> DataFrame:
    names = ", ".join(f"CASE WHEN {condition} THEN '{table}' END"
                      for table, condition, _, _ in entries)
    listed = rows.selectExpr("*", f"explode(filter(array({names}), x -> x IS NOT NULL)) AS tbl")

    def by_table(i: int) -> str:
        return "CASE tbl " + " ".join(f"WHEN '{e[0]}' THEN {e[i]}" for e in entries) + " END"

    return listed.selectExpr("k", "id", "event_ms", "seq", "tbl", f"{by_table(2)} AS body",
                             f"{by_table(3)} AS arrival_ts")


def _line_changes(t: Tables) -> DataFrame:
    now = _line_arrival(0)
    return _changes(
        _lines_with_parts(t),
        _entry("order_detail", "TRUE", DETAIL_COLUMNS, now),
        _entry("order_detail_activity", IS_ACTIVITY, ACTIVITY_COLUMNS, _line_arrival(900)),
        _entry("order_detail_coupon", IS_COUPON, COUPON_COLUMNS, _line_arrival(2500)),
        _entry("order_refund_info", "flag = 'R' AND status = 'F'",
               ["id", "CAST(o AS STRING) AS order_id", "CAST(l_partkey AS STRING) AS sku_id",
                "CAST(price AS STRING) AS refund_amount"], now),
        _entry("coupon_use", IS_COUPON,
               ["id", "CAST(l_suppkey AS STRING) AS coupon_id", "CAST(o AS STRING) AS order_id"],
               now))


def _order_changes(t: Tables) -> DataFrame:
    payment = ["id", "CAST(k AS STRING) AS order_id", "total AS total_amount"]
    return _changes(
        _orders(t),
        _entry("order_info", "TRUE", ORDER_COLUMNS, ORDER_ARRIVAL),
        _entry("payment_info", "o_orderstatus = 'F'", payment, ORDER_ARRIVAL),
        _entry("refund_payment", "o_orderstatus = 'P'", payment, ORDER_ARRIVAL),
        _entry("order_status_log", "TRUE",
               ["id", "CAST(k AS STRING) AS order_id", "o_orderstatus AS order_status",
                "CAST(k AS DECIMAL(38,2)) * 1000000000000000000 AS weight"],
               ORDER_ARRIVAL))


def _event_changes(t: Tables) -> DataFrame:
    visit = ["id", "CAST(user_id AS STRING) AS user_id", "CAST(k % 200 AS STRING) AS sku_id"]
    rows = t["events"].selectExpr(
        "event_id", "event_id AS k", "CAST(event_id AS STRING) AS id", "user_id", "event_type",
        f"{PAGE_SECONDS} * 1000 AS event_ms", "'' AS seq")
    return _changes(
        rows,
        _entry("cart_info", "event_type = 'click'", visit + ["'1' AS sku_num"], PAGE_ARRIVAL),
        _entry("favor_info", "event_type = 'view'", visit, PAGE_ARRIVAL),
        _entry("comment_info", "event_type = 'purchase'", visit, PAGE_ARRIVAL))


def _unrouted_changes(t: Tables, table: str, base: str, key: str, name: str) -> DataFrame:
    """Tables without a detail stream."""
    rows = t[base].selectExpr(
        f"CAST({key} AS BIGINT) AS k", f"CAST({key} AS STRING) AS id", f"{name} AS name",
        f"({DAY_ONE} + CAST({key} AS BIGINT) % 100) * 1000 AS event_ms", "'' AS seq")
    return _changes(rows, _entry(table, "TRUE", ["id", "name"], _arrival("k % 100")))


def _text(rows: DataFrame, value: str, arrival: str, seq: str) -> DataFrame:
    """The text stream; building the text is kept apart from later filters on it."""
    return rows.selectExpr(f"{arrival} AS arrival_ts", f"{seq} AS seq",
                           f"inline(array(struct({value} AS value)))")


def change_text(changes: DataFrame) -> DataFrame:
    """Change rows as event text.

    By change key % 101: 0 cut text, 1 blank id, 2 no op, 3 unknown op, 4 no after.
    Otherwise key % 97 = 0 is a delete, key % 10 gives the op, and every seventh key
    names its table at the root instead of in ``source``.
    """
    dirt = "k % 101 BETWEEN 1 AND 4"
    op = (f"CASE WHEN k % 101 = 2 THEN NULL WHEN k % 101 = 3 THEN 'x' WHEN {dirt} THEN 'c' "
          "WHEN k % 97 = 0 THEN 'd' WHEN k % 10 = 0 THEN 'r' WHEN k % 10 = 1 THEN 'u' ELSE 'c' END")
    side = (f"CASE WHEN NOT ({dirt}) AND k % 97 = 0 THEN concat('\"before\":', body, ',') "
            "WHEN k % 101 = 4 THEN '' ELSE concat('\"after\":', body, ',') END")
    place = ("CASE WHEN k % 7 = 0 THEN concat('\"table\":\"', tbl, '\",') "
             "ELSE concat('\"source\":{\"table\":\"', tbl, '\"},') END")
    event = (f"concat('{{', coalesce(concat('\"op\":\"', {op}, '\",'), ''), {side}, {place}, "
             "'\"ts_ms\":', event_ms, '}')")
    cut = """concat('{"op":"c","source":{"table":"', tbl, '"},"after":{"id":"', id, '"')"""
    return _text(changes, f"CASE WHEN k % 101 = 0 THEN {cut} ELSE {event} END", "arrival_ts", "seq")


def trade_text(t: Tables) -> DataFrame:
    """Changes of orders and order lines."""
    return change_text(_line_changes(t).unionByName(_order_changes(t)))


def db_text(t: Tables) -> DataFrame:
    """Change events of all tables as one text stream."""
    rows = _line_changes(t)
    for more in (_order_changes(t), _event_changes(t),
                 _unrouted_changes(t, "user_info", "customer", "c_custkey", "c_name"),
                 _unrouted_changes(t, "sku_info", "part", "p_partkey", "p_name"),
                 _unrouted_changes(t, "base_province", "nation", "n_nationkey", "n_name")):
        rows = rows.unionByName(more)
    return change_text(rows)


def log_text(t: Tables) -> DataFrame:
    """App log records, one per event.

    By event id % 103: 0 blank mid, 1 no common, 2 no ts, 3 neither page nor start,
    4 page is a number, 5 ts is no time; event id % 101 = 0 is cut text.
    """
    e = "event_id"
    common = (f"struct(CASE WHEN {e} % 103 = 0 THEN ' ' ELSE concat('mid_', user_id) END AS mid, "
              f"CASE WHEN {e} % 11 <> 0 THEN concat('sid_', user_id, '_', {e} % 5) END AS sid)")
    actions = "CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END"
    displays = f"CASE WHEN event_type = 'view' THEN CAST({e} % 4 AS INT) ELSE 0 END"

    def several(n: str, item: str) -> str:
        return f"CASE WHEN {n} > 0 THEN transform(sequence(1, greatest({n}, 1)), i -> {item}) END"

    body = ("to_json(struct("
            f"CASE WHEN {e} % 103 <> 1 THEN {common} END AS common, "
            f"CASE WHEN (event_type = 'signup' OR {e} % 10 = 0) AND {e} % 103 <> 3 "
            f"THEN struct('icon' AS entry, {e} % 1000 AS loading_time) END AS start, "
            + several(displays, f"struct(concat('item_', {e} % 50) AS item, i AS pos_id)")
            + " AS displays, "
            + several(actions, f"struct(concat('act_', i) AS action_id, {e} % 50 AS item, 1 AS ts)")
            + " AS actions, "
            f"CASE WHEN event_type = 'error' THEN struct({e} % 500 AS error_code, 'E' AS msg) END "
            f"AS err, CASE WHEN {e} % 103 = 5 THEN 9223372036854775807 "
            f"WHEN {e} % 103 <> 2 THEN {PAGE_SECONDS} * 1000 END AS ts))")
    page = (f"CASE WHEN event_type = 'signup' OR {e} % 103 = 3 THEN '' "
            f"WHEN {e} % 103 = 4 THEN '\"page\":7,' ELSE concat('\"page\":{{\"page_id\":\"page_', "
            f"{e} % 20, '\",\"during_time\":', {e} % 3000, '}},') END").replace("{{", "{").replace("}}", "}")
    return _text(
        t["events"],
        f"CASE WHEN {e} % 101 = 0 THEN concat('{{\"common\":{{\"mid\":\"', {e}) "
        f"ELSE concat('{{', {page}, substring({body}, 2)) END",
        f"timestamp_seconds({PAGE_SECONDS})", f"CAST({e} AS STRING)")


def delayed_log_text(t: Tables) -> DataFrame:
    """The same records, each arriving up to ten times nine seconds after its time."""
    delay = "((CAST(seq AS BIGINT) * 13) % 10) * ((CAST(seq AS BIGINT) * 7) % 10)"
    return log_text(t).selectExpr("value", f"arrival_ts + make_dt_interval(0, 0, 0, {delay}) AS arrival_ts", "seq")


#: Orders per chunk of the order snapshot.
CHUNK = 1000


def order_changes(t: Tables) -> DataFrame:
    """Up to three versions of every order along one change log; every fifth order ends with
    a delete.  ``key, op, position, value``."""
    return t["orders"].selectExpr(
        "o_orderkey AS key", "explode(sequence(0, 2)) AS v", "o_totalprice").selectExpr(
        "key", "CASE WHEN v = 2 AND key % 5 = 0 THEN 'd' WHEN v = 0 THEN 'c' ELSE 'u' END AS op",
        "(key * 7919) % 50000 + v * 20000 AS position",
        "concat(CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS STRING), ' v', v) AS value")


def order_chunks(t: Tables) -> DataFrame:
    """Positions of the log before and after each chunk of orders was read."""
    return (t["orders"].selectExpr(f"o_orderkey DIV {CHUNK} AS chunk").distinct()
            .selectExpr("chunk", "(chunk * 1543) % 60000 AS low", "(chunk * 1543) % 60000 + 15000 AS high"))


def order_snapshot(t: Tables) -> DataFrame:
    """What reading the chunks found, each at some position between low and high."""
    changes = order_changes(t).withColumn("chunk", F.expr(f"key DIV {CHUNK}")).join(order_chunks(t), "chunk")
    seen = changes.filter(F.col("position") <= F.col("low") + F.col("key") % 15000)
    newest = seen.groupBy("key").agg(F.max_by(F.struct("op", "value"), "position").alias("row"))
    return newest.filter("row.op <> 'd'").select("key", "row.value")


# configuration changes: second, op, source table, sink table, family, row key, columns, type
CONFIG_EVENTS = """
    (0, 'r', 'user_info', 'dim_user_info', NULL, NULL, 'name, nation', 'dim'),
    (0, 'r', 'sku_info', 'dim_sku_info', 'cf', ' ', NULL, NULL),
    (1000, 'c', 'base_province', 'dim_base_province', 'info', 'id', 'name,,region ', 'DIM'),
    (1500, 'u', 'user_info', 'dim_user_info', 'info', 'id', 'name,nation,balance', 'dim'),
    (2000, 'd', 'sku_info', 'dim_sku_info', 'cf', NULL, NULL, 'dim'),
    (2500, 'u', 'base_province', 'dim_base_province', 'info', 'id', 'name', 'dwd'),
    (3000, 'c', 'sku_info', 'dim_sku_info', 'cf', 'id', 'name,brand', 'dim'),
    (3500, 'u', 'base_province', 'dim_base_province', 'info', 'id', NULL, 'dim')
"""


def config_text(spark: SparkSession) -> DataFrame:
    body = ("struct(source_table, sink_table, sink_family, sink_row_key, sink_columns, sink_type)")
    rows = spark.sql(f"SELECT * FROM VALUES {CONFIG_EVENTS} AS v(s, op, source_table, sink_table, "
                     "sink_family, sink_row_key, sink_columns, sink_type)")
    return rows.selectExpr(
        f"to_json(struct(op, CASE WHEN op = 'd' THEN {body} END AS before, "
        f"CASE WHEN op <> 'd' THEN {body} END AS after)) AS value",
        f"{_arrival('s')} AS arrival_ts", "'' AS seq")


# source table, base table, key, columns; the first column changes with each version
# and the last one is null in the second version
DIM_SOURCES = [
    ("user_info", "customer", "c_custkey",
     {"name": "c_name", "nation": "CAST(c_nationkey AS STRING)",
      "balance": "CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS STRING)"}),
    ("sku_info", "part", "p_partkey",
     {"name": "p_name", "size": "CAST(p_size AS STRING)", "brand": "p_brand"}),
    ("base_province", "nation", "n_nationkey",
     {"name": "n_name", "zone": "CAST(n_regionkey + 1 AS STRING)",
      "region": "CAST(n_regionkey AS STRING)"}),
]


def dim_text(t: Tables) -> DataFrame:
    """Dimension changes: a first version of every row, a second one with a null column
    for every seventh key, a delete for every 13th and a new row after it for every 26th."""
    result = None
    for table, base, key, columns in DIM_SOURCES:
        (first, first_sql), (middle, middle_sql), (last, last_sql) = columns.items()
        rows = t[base].selectExpr(
            f"CAST({key} AS BIGINT) AS k", f"{first_sql} AS a", f"{middle_sql} AS b",
            f"{last_sql} AS z",
            "explode(filter(array(1, CASE WHEN {k} % 7 = 0 THEN 2 END, CASE WHEN {k} % 13 = 0 "
            "THEN 3 END, CASE WHEN {k} % 26 = 0 THEN 4 END), x -> x IS NOT NULL)) AS v"
            .format(k=key))
        body = (f"struct(CAST(k AS STRING) AS id, CASE WHEN v = 1 THEN a ELSE concat(a, '#', v) END "
                f"AS {first}, b AS {middle}, CASE WHEN v <> 2 THEN z END AS {last})")
        text = rows.selectExpr(
            "to_json(struct(CASE v WHEN 2 THEN 'u' WHEN 3 THEN 'd' ELSE 'c' END AS op, "
            f"CASE WHEN v = 3 THEN {body} END AS before, CASE WHEN v <> 3 THEN {body} END AS after, "
            f"struct('{table}' AS table) AS source), map('ignoreNullFields', 'false')) AS value",
            f"{_arrival('(k * 37) % 2400 + v * 600')} AS arrival_ts", "CAST(v AS STRING) AS seq")
        result = text if result is None else result.unionByName(text)
    return result
