"""Change events: read the envelope, judge it, and name the detail stream it belongs to."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.functions import (
    add_once, is_blank, is_object_text, json_field, json_put, json_string, keep_numbers,
    parse_integer, parse_once, plain_member_put, restore_numbers,
)
from rillhouse.sources.schemas import CHANGE_SCHEMA, DIRTY_STREAM, DWD_FIELDS, DWD_ROUTES


def read_changes(rows: DataFrame, value: str = "value") -> DataFrame:
    """Add ``op, source_table, before, after, ts_ms``; nested rows stay JSON text.

    When a ``source`` object is present its ``table`` counts even if null; the root
    ``table`` is only used without one.  A ``source`` that is no object gives null.
    """
    parsed = parse_once(rows, value, CHANGE_SCHEMA)
    table = (F.when(F.col("source").isNull(), F.col("table"))
             .when(is_object_text(F.col("source")), json_field(F.col("source"), "table")))
    return (add_once(parsed, source_table=table).drop("source", "table")
            .withColumnRenamed("ts_ms", "ts_text"))


def judge_changes(changes: DataFrame) -> DataFrame:
    """Add ``verdict`` (pass, delete, dirty), ``reason`` and ``ts_ms``.

    The checks run in this order; the first that fails decides.  A delete leaves
    silently, it is not dirty.
    """
    op, after, ts = F.col("op"), F.col("after"), F.col("ts_text")
    reason = (
        F.when(is_blank(F.col("source_table")) | is_blank(op), F.lit("no table or op"))
        .when(op == "d", F.lit(None))
        .when(~op.isin("c", "r", "u"), F.lit("unknown op"))
        .when(after.isNull(), F.lit("no after"))
        .when(~is_object_text(after), F.lit("after is no object"))
        .when(is_blank(json_field(after, "id")), F.lit("no id"))
        .when(~is_blank(ts) & parse_integer(ts).isNull(), F.lit("bad ts_ms")))
    judged = add_once(changes, reason=reason, ts_ms=parse_integer(ts))
    verdict = (F.when(F.col("reason").isNotNull(), F.lit("dirty"))
               .when(op == "d", F.lit("delete")).otherwise(F.lit("pass")))
    return judged.withColumn("verdict", verdict).drop("ts_text")


def stream_of(table: Column) -> Column:
    """Detail stream of a source table; null when the table has none."""
    pairs = [x for table_name, stream in DWD_ROUTES.items()
             for x in (F.lit(table_name), F.lit(stream))]
    return F.element_at(F.create_map(*pairs), table)


def route_changes(judged: DataFrame) -> DataFrame:
    """Add ``route``: a detail stream, the dirty stream, or null for rows that leave."""
    return judged.withColumn(
        "route",
        F.when(F.col("verdict") == "dirty", F.lit(DIRTY_STREAM))
        .when(F.col("verdict") == "pass", stream_of(F.col("source_table"))))


def split_changes(rows: DataFrame) -> DataFrame:
    """Envelope, verdict and route in one narrow pass over the text stream."""
    return route_changes(judge_changes(read_changes(rows)))


def may_belong(text: DataFrame, tables: Iterable[str], value: str = "value") -> DataFrame:
    """Texts without those that cannot be a change of one of ``tables``: a JSON text without
    escapes holds its table's name as it is, up to the quote.  A search of the text costs a
    fraction of gate and split; the rows left are judged by these as before."""
    c = F.col(value)
    found = F.contains(c, F.lit("\\"))
    for table in tables:
        for quote in ('"', "'"):
            found = found | F.contains(c, F.lit(table + quote))
    return text.filter(found)


def detail_text(routed: DataFrame) -> DataFrame:
    """``route, value`` as sent on: the row plus ``_source_table, _op, _ts_ms``;
    dirty rows keep their original text.  Numbers keep their spelling.  Most rows are cut out of
    their event as they stand, the others are parsed and written anew."""
    members = {"_source_table": json_string(F.col("source_table")), "_op": json_string(F.col("op")),
               "_ts_ms": F.col("ts_ms").cast("string")}
    plain = plain_member_put(F.col("value"), "after", members)
    parsed = restore_numbers(json_put(json_field(keep_numbers(F.col("value")), "after"), members))
    return routed.filter(F.col("route").isNotNull()).select(
        "route",
        F.when(F.col("route") == DIRTY_STREAM, F.col("value")).otherwise(F.coalesce(plain, parsed)).alias("value"),
        "arrival_ts", "seq")


def detail_table(routed: DataFrame, table: str) -> DataFrame:
    """Typed detail stream of one table: its text columns and the three metadata columns."""
    fields = DWD_FIELDS[table]
    schema = ", ".join(f"{name} string" for name in fields)
    rows = routed.filter(F.col("route") == DWD_ROUTES[table]).select(
        F.col("source_table").alias("_source_table"), F.col("op").alias("_op"),
        F.col("ts_ms").alias("_ts_ms"), "value", "arrival_ts", "seq", "after")
    return parse_once(rows, "after", schema).drop("after")


def read_detail_text(rows: DataFrame, table: str) -> DataFrame:
    """Typed columns from a detail stream that was stored as text."""
    schema = ", ".join(f"{name} string" for name in
                       DWD_FIELDS[table] + ["_source_table", "_op"]) + ", _ts_ms bigint"
    return parse_once(rows, "value", schema)
