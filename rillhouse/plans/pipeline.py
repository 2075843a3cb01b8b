"""Whole paths as batch plans, from entry text to window tables.

The streaming jobs run the same operators; these plans serve first loads,
corrections of past days and tests.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.functions import add_once, parse_once
from rillhouse.operators import changes, facts, gate, logs, windows
from rillhouse.session import clear_files
from rillhouse.sources.schemas import (
    ACTIVITY_FIELDS, COUPON_FIELDS, DETAIL_FIELDS, DIRTY_STREAM, DWD_ROUTES, ORDER_FIELDS,
)


def gated(text: DataFrame) -> DataFrame:
    return gate.passed(gate.with_gate_reason(text))


FACT_INPUTS = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")


def trade_inputs(text: DataFrame, spool: str | None = None) -> list[DataFrame]:
    """The four fact inputs from change-event text.

    With ``spool``, a new folder, the text goes through gate and split once and its rows are kept
    there by route, as the streaming jobs do; each input then reads its own route.
    """
    routed = changes.split_changes(gated(changes.may_belong(text, FACT_INPUTS)))
    if spool is not None:
        wanted = F.col("route").isin(*(DWD_ROUTES[t] for t in FACT_INPUTS))
        unread = {n: F.lit(None).cast("string") for n in ("value", "before")}
        routed = routed.withColumns(unread)
        routed.filter(wanted).write.option("compression", "zstd").partitionBy("route").parquet(spool)
        routed = text.sparkSession.read.schema(routed.schema).parquet(spool)
    return [changes.detail_table(routed, t) for t in FACT_INPUTS]


def settled_fact(text: DataFrame, spool: str | None = None,
                 columns: Iterable[str] | None = None) -> DataFrame:
    inputs = facts.clean_inputs(*trade_inputs(text, spool))
    if spool is None:
        return facts.settle(*inputs, columns=columns)

    def worked_off() -> None:
        for table in FACT_INPUTS:
            clear_files(text.sparkSession, f"{spool}/route={DWD_ROUTES[table]}", ".parquet")

    return facts.settle_in_parts(*inputs, f"{spool}-fact", columns, evaluated=worked_off)


#: What the trade windows read of a fact.
READ_BY = {"dws_trade_sku_order_window": windows.SKU_COLUMNS,
           "dws_trade_province_order_window": windows.PROVINCE_COLUMNS}
CHECKED = ["id", *dict.fromkeys([*windows.SKU_KEYS, *windows.PROVINCE_KEYS]), "split_total_amount", "sku_num"]


def trade_windows(fact: DataFrame, time_mode: str = "event",
                  with_ts: bool = True) -> dict[str, DataFrame]:
    """The trade window tables for which the fact has the columns (``READ_BY``)."""
    made = {"dws_trade_sku_order_window": (windows.sku_windows, windows.parse_sku_facts),
            "dws_trade_province_order_window": (windows.province_windows, windows.parse_province_facts)}
    return {table: windowed(parse(fact, time_mode), with_ts=with_ts)
            for table, (windowed, parse) in made.items() if set(READ_BY[table]) <= set(fact.columns)}


def page_views(text: DataFrame) -> DataFrame:
    """Parsed page views from log text."""
    pages = logs.log_stream(logs.split_logs(gated(text)), "page")
    return windows.parse_page_views(pages.withColumnRenamed("item", "page_item"))


def traffic_windows(text: DataFrame, with_ts: bool = True) -> DataFrame:
    return windows.traffic_windows(page_views(text), with_ts=with_ts)


def window_dirty(fact: DataFrame) -> DataFrame:
    """Facts that a window table rejects: ``stage, reason`` and the fact's columns, for all
    tables in one pass over the facts."""
    both = [F.struct(F.lit(stage).alias("stage"), reason.alias("reason")) for stage, reason in (
        ("dws_trade_sku", windows.sku_reason()), ("dws_trade_province", windows.province_reason()))]
    rejected = F.filter(F.array(*both), lambda x: x["reason"].isNotNull())
    return fact.select("*", F.inline(rejected)).select(*fact.columns, "reason", "stage")


def page_view_dirty(text: DataFrame) -> DataFrame:
    """Page logs that the traffic window rejects."""
    views = page_views(text).filter(F.col("reason").isNotNull())
    return views.withColumn("stage", F.lit("dws_traffic"))


def judged_trade(text: DataFrame) -> DataFrame:
    """Change events with the ``stage`` and ``reason`` of their rejection on the way to the fact,
    in one narrow pass: a row is rejected at most once on its way."""
    at_gate = gate.with_gate_reason(text).withColumnRenamed("reason", "gate_reason")
    routed = (changes.split_changes(at_gate).withColumnRenamed("reason", "split_reason")
              .drop("before"))
    fields = dict.fromkeys(DETAIL_FIELDS + ORDER_FIELDS + ACTIVITY_FIELDS + COUPON_FIELDS)
    typed = parse_once(routed, "after", ", ".join(f"{n} string" for n in fields))
    table = F.col("source_table")
    passes = F.col("verdict") == "pass"
    fact_reason = (
        F.when(passes & (table == "order_detail"), facts.detail_reason())
        .when(passes & (table == "order_info"), facts.order_reason())
        .when(passes & table.isin("order_detail_activity", "order_detail_coupon"),
              facts.promotion_reason()))
    stage = (F.when(F.col("gate_reason").isNotNull(), F.lit("ods_db"))
             .when(F.col("split_reason").isNotNull(), F.lit("dwd_split"))
             .otherwise(F.concat(F.lit("fact_"), table)))
    return add_once(typed, stage=stage,
                    reason=F.coalesce("gate_reason", "split_reason", fact_reason)).drop(*fields)


def dirty_of_trade(text: DataFrame) -> DataFrame:
    """Everything the trade path rejects, with the original text and the stage that
    rejects it."""
    return judged_trade(text).filter(F.col("reason").isNotNull()).select(*gate.DIRTY_COLUMNS)


def trade_path(text: DataFrame, spool: str) -> tuple[DataFrame, DataFrame]:
    """``dirty_of_trade`` and the four fact inputs behind their checks (``settle`` takes them),
    both from one pass of gate, split and checks over the text.  Rejected rows and the inputs
    are kept by route in ``spool``, a new folder."""
    judged = judged_trade(text)
    kept = judged.withColumn("route", F.when(F.col("reason").isNotNull(), F.lit(DIRTY_STREAM)).otherwise(F.col("route")))
    kept = kept.filter(F.col("route").isin(DIRTY_STREAM, *(DWD_ROUTES[t] for t in FACT_INPUTS)))
    is_dirty = F.col("route") == DIRTY_STREAM
    kept = kept.select(*[F.when(is_dirty, F.col(n)).alias(n) for n in ("stage", "value", "reason")], "arrival_ts",
                       "seq", *[F.when(~is_dirty, F.col(n)).alias(n) for n in ("source_table", "op", "ts_ms", "after")],
                       "route")
    kept.write.partitionBy("route").parquet(spool)
    stored = text.sparkSession.read.schema(kept.schema).parquet(spool)
    dirty = stored.filter(is_dirty).select(*gate.DIRTY_COLUMNS)
    return dirty, [changes.detail_table(stored, t) for t in FACT_INPUTS]
