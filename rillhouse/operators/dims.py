"""Dimension tables driven by a changing configuration.

A configuration row names, for a source table, the target table, column family,
row-key column and stored columns.  A change event is handled by the
configuration valid when it arrived; events that come before their configuration
are dropped.  A dimension row is a set of text cells; a null value never
overwrites a cell, and a delete removes the whole row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.functions import (
    add_once, default_if_blank, equals_ignore_case, parse_once, split_and_trim,
)
from rillhouse.operators.changes import read_changes
from rillhouse.sources.schemas import DIM_CONFIG_FIELDS

ROW = ["sink_table", "row_key"]
CELL = ROW + ["family", "column"]
_NEVER = "timestamp'9999-12-31 00:00:00'"


def read_config(rows: DataFrame) -> DataFrame:
    """Configuration events from the text of their change feed.

    ``action`` is ``remove`` for deletes and for rows whose type is not ``dim``,
    otherwise ``put``.  Rows without a source table are ignored.
    """
    changes = read_changes(rows).drop("source_table")
    body = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    schema = ", ".join(f"{n} string" for n in DIM_CONFIG_FIELDS)
    parsed = parse_once(changes.select("op", "arrival_ts", "seq", body.alias("body")),
                        "body", schema)
    c = F.col
    is_dim = equals_ignore_case(c("sink_type"), "dim")
    return (parsed.select(
                "op", "arrival_ts", "seq",
                "source_table", "sink_table",
                default_if_blank(c("sink_family"), "info").alias("sink_family"),
                default_if_blank(c("sink_row_key"), "id").alias("sink_row_key"),
                split_and_trim(c("sink_columns")).alias("sink_columns"),
                default_if_blank(c("sink_type"), "dim").alias("sink_type"))
            .filter(c("source_table") != "")
            .withColumn("action", F.when((F.coalesce(c("op"), F.lit("")) == "d") | ~is_dim,
                                         F.lit("remove")).otherwise(F.lit("put"))))


def config_periods(config: DataFrame) -> DataFrame:
    """Each configuration with the time span ``[valid_from, valid_to)`` it holds for."""
    per_table = Window.partitionBy("source_table").orderBy("arrival_ts", "seq")
    spans = config.withColumn(
        "valid_to", F.coalesce(F.lead("arrival_ts").over(per_table), F.expr(_NEVER)))
    return (spans.withColumnRenamed("arrival_ts", "valid_from")
            .filter((F.col("action") == "put") & (F.col("valid_from") < F.col("valid_to")))
            .drop("op", "seq", "action"))


def read_dim_changes(rows: DataFrame) -> DataFrame:
    """``op, source_table, body`` with the row before a delete, else after the change.
    Other events and unreadable texts are ignored here."""
    changes = read_changes(rows)
    body = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return (changes.filter((F.col("source_table") != "") & F.col("op").isin("c", "r", "u", "d"))
            .select("source_table", "op", body.alias("body"), "arrival_ts", "seq"))


def with_config(changes: DataFrame, periods: DataFrame) -> DataFrame:
    """As-of join.  No broadcast is forced: the optimizer broadcasts the periods when
    their measured size allows it and splits a hot source table otherwise."""
    joined = changes.alias("m").join(
        periods.alias("p"),
        (F.col("m.source_table") == F.col("p.source_table"))
        & (F.col("m.arrival_ts") >= F.col("p.valid_from"))
        & (F.col("m.arrival_ts") < F.col("p.valid_to")))
    return joined.select("m.*", *[f"p.{n}" for n in DIM_CONFIG_FIELDS[1:5]])


def project_dims(configured: DataFrame) -> DataFrame:
    """Row key and stored cells of every change.

    The row-key column is no cell, null values are skipped, and a column list keeps
    only its columns.  Rows without a key leave; so do upserts without any cell.
    """
    c = F.col
    data = add_once(configured, data=F.from_json("body", "map<string,string>"))
    cells = F.map_filter(
        "data", lambda name, value: (name != c("sink_row_key")) & value.isNotNull()
        & (c("sink_columns").isNull() | F.array_contains(c("sink_columns"), name)))
    is_delete = c("op") == "d"
    keyed = data.withColumn("row_key", F.try_element_at("data", c("sink_row_key")))
    return (add_once(keyed.filter(F.length("row_key") > 0), cells=F.when(~is_delete, cells))
            .filter(is_delete | (F.size("cells") > 0))
            .select("sink_table", "row_key", F.col("sink_family").alias("family"),
                    F.when(is_delete, F.lit("delete")).otherwise(F.lit("put")).alias("action"),
                    "cells", "arrival_ts", "seq"))


def cell_log(projected: DataFrame) -> DataFrame:
    """One row per written cell, and one row with null column per delete."""
    listed = F.when(F.col("action") == "put", F.map_entries("cells")).otherwise(
        F.array(F.struct(F.lit(None).cast("string").alias("key"),
                         F.lit(None).cast("string").alias("value"))))
    return (projected.select("sink_table", "row_key", "family", F.explode(listed).alias("_c"),
                             "arrival_ts", "seq")
            .select("sink_table", "row_key", "family", F.col("_c.key").alias("column"),
                    F.col("_c.value").alias("cell"), "arrival_ts", "seq"))


def fold_cells(log: DataFrame) -> DataFrame:
    """Current cells: the newest value of each, if written after the row's last delete.

    Both sides are aggregates with partial results per task, so a row that changes
    very often does not collect in one place.
    """
    order = F.struct("arrival_ts", "seq")
    newest = (log.filter(F.col("column").isNotNull())
              .groupBy(*CELL).agg(F.max_by("cell", order).alias("cell"),
                                  F.max(order).alias("written")))
    deleted = (log.filter(F.col("column").isNull())
               .groupBy(*ROW).agg(F.max(order).alias("deleted")))
    return (newest.join(deleted, ROW, "left")
            .filter(F.col("deleted").isNull() | (F.col("written") > F.col("deleted")))
            .select(*CELL, "cell", F.col("written.arrival_ts").alias("arrival_ts"),
                    F.col("written.seq").alias("seq")))


def compact_log(log: DataFrame, forget_before: Column | None = None) -> DataFrame:
    """The shortest log with the same current cells, now and with whatever is added later:
    the newest value of each living cell, and the last delete of each row.  Deletes before
    ``forget_before`` are left out; no cell that old may be added any more."""
    order = F.struct("arrival_ts", "seq")
    deleted = (log.filter(F.col("column").isNull())
               .groupBy(*ROW, "family").agg(F.max(order).alias("last"))
               .select(*ROW, "family", F.lit(None).cast("string").alias("column"),
                       F.lit(None).cast("string").alias("cell"), "last.arrival_ts", "last.seq"))
    if forget_before is not None:
        deleted = deleted.filter(F.col("arrival_ts") >= forget_before)
    return fold_cells(log).unionByName(deleted)


def dim_table(cells: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension table with named text columns."""
    picked = [F.max(F.when(F.col("column") == n, F.col("cell"))).alias(n) for n in columns]
    return (cells.filter(F.col("sink_table") == sink_table)
            .groupBy("row_key").agg(*picked))


def dim_rows(cells: DataFrame) -> DataFrame:
    """All tables as ``sink_table, row_key, cells``; a row's cells are as many as its
    columns."""
    entry = F.struct(F.concat_ws(":", "family", "column"), F.col("cell"))
    return cells.groupBy(*ROW).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("cells"))
