"""Entry gate: only texts that are exactly one JSON object go on, unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.functions import add_once, is_json_object

DIRTY_COLUMNS = ["stage", "value", "reason", "arrival_ts"]


def with_gate_reason(rows: DataFrame, value: str = "value") -> DataFrame:
    """Add ``reason``: null for rows that pass."""
    return add_once(
        rows, reason=F.when(~is_json_object(F.col(value)), F.lit("not a JSON object")))


def passed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull()).drop("reason")


def dirty(rows: DataFrame, stage: str, value: str | Column = "value") -> DataFrame:
    """Rejected rows with their original text."""
    text = F.col(value) if isinstance(value, str) else value
    return rows.filter(F.col("reason").isNotNull()).select(
        F.lit(stage).alias("stage"), text.alias("value"), "reason", "arrival_ts")


def union_dirty(*frames: DataFrame) -> DataFrame:
    """All dirty rows of several stages as one stream."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
