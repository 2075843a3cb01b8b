"""App logs: clean the record and split it into five streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.functions import (
    add_once, is_blank, is_object_text, json_field, json_put, json_value, keep_numbers,
    parse_integer, parse_once, restore_numbers,
)
from rillhouse.sources.schemas import DIRTY_STREAM, LOG_ROUTES, LOG_SCHEMA


def read_logs(rows: DataFrame, value: str = "value") -> DataFrame:
    """Add the record's parts (nested ones as JSON text) and ``mid, sid, ts``."""
    parsed = parse_once(rows, value, LOG_SCHEMA)
    with_ids = parse_once(parsed, "common", "mid string, sid string")
    return with_ids.withColumn("ts", parse_integer(F.col("ts")))


def _bad_object(part: Column) -> Column:
    return part.isNotNull() & ~is_object_text(part)


def _bad_items(part: Column, items: Column) -> Column:
    return part.isNotNull() & (items.isNull() | F.exists(items, lambda x: ~is_object_text(x)))


def judge_logs(logs: DataFrame) -> DataFrame:
    """Add ``reason`` (null for clean records)."""
    c = F.col
    listed = add_once(logs, display_items=F.from_json("displays", "array<string>"),
                      action_items=F.from_json("actions", "array<string>"))
    reason = (
        F.when(~is_object_text(c("common")), F.lit("no common"))
        .when(c("ts").isNull(), F.lit("no ts"))
        .when(is_blank(c("mid")), F.lit("no mid"))
        .when(c("page").isNull() & c("start").isNull(), F.lit("neither page nor start"))
        .when(_bad_object(c("page")) | _bad_object(c("start")) | _bad_object(c("err"))
              | _bad_items(c("displays"), c("display_items"))
              | _bad_items(c("actions"), c("action_items")), F.lit("bad nested value")))
    return add_once(listed, reason=reason)


def split_logs(rows: DataFrame) -> DataFrame:
    return judge_logs(read_logs(rows))


def log_stream(judged: DataFrame, kind: str) -> DataFrame:
    """One of the streams page, start, display, action, error.

    page and start carry the whole record; a display, action or error becomes a row
    of its own (``item``) with the record's common, page and ts.
    """
    clean = judged.filter(F.col("reason").isNull())
    columns = ["common", "page", "ts", "mid", "sid", "value", "arrival_ts", "seq"]
    if kind in ("page", "start"):
        return clean.filter(F.col(kind).isNotNull()).select(F.col(kind).alias("item"), *columns)
    if kind == "error":
        return clean.filter(F.col("err").isNotNull()).select(F.col("err").alias("item"), *columns)
    return clean.select(F.explode(f"{kind}_items").alias("item"), *columns)


def log_text(judged: DataFrame) -> DataFrame:
    """``route, value`` for all five streams and the dirty stream in one narrow pass.

    A display, action or error gets common, page and ts put over its own members; numbers
    keep their spelling.
    """
    def entry(route: str, value: Column) -> Column:
        return F.struct(F.lit(route).alias("route"), value.alias("value"))

    parts = F.from_json(keep_numbers(F.col("value")),
                        "common string, page string, displays array<string>, actions array<string>, err string")
    kept = add_once(judged, kept=parts)

    def with_context(item: Column) -> Column:
        return restore_numbers(json_put(item, {
            "common": F.col("kept.common"), "page": F.col("kept.page"), "ts": json_value(F.col("ts"))}))

    none = F.array().cast("array<struct<route:string,value:string>>")
    clean = F.col("reason").isNull()

    def when(condition: Column, entries: Column) -> Column:
        return F.when(condition, entries).otherwise(none)

    def per_item(items: str, route: str) -> Column:
        entries = F.transform(items, lambda x: entry(route, with_context(x)))
        return when(clean & F.col(items).isNotNull(), entries)

    outputs = F.concat(
        when(~clean, F.array(entry(DIRTY_STREAM, F.col("value")))),
        when(clean & F.col("start").isNotNull(),
             F.array(entry(LOG_ROUTES["start"], F.col("value")))),
        when(clean & F.col("page").isNotNull(),
             F.array(entry(LOG_ROUTES["page"], F.col("value")))),
        per_item("kept.displays", LOG_ROUTES["display"]),
        per_item("kept.actions", LOG_ROUTES["action"]),
        when(clean & F.col("err").isNotNull(),
             F.array(entry(LOG_ROUTES["error"], with_context(F.col("kept.err"))))))
    listed = add_once(kept, outputs=outputs)
    return listed.select(F.inline("outputs"), "arrival_ts", "seq")


def item_fields(stream: DataFrame, *names: str) -> DataFrame:
    """Read text fields out of ``item``."""
    rows = stream.withColumnRenamed("item", "_item")  # an item may have a field of that name
    return parse_once(rows, "_item", ", ".join(f"`{n}` string" for n in names)).drop("_item")


def page_fields(stream: DataFrame, *names: str) -> DataFrame:
    """Read text fields out of ``page``."""
    result = stream
    for name in names:
        result = result.withColumn(name, json_field(F.col("page"), name))
    return result
