"""Evaluate costly expressions one time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns like ``withColumns``, but so that later filters cannot copy them.

    The optimizer moves a filter below a projection by writing the projection's
    expressions into it, so each parse of a document would run again for every
    filter that looks at its result, and chained steps would multiply.  A one-element
    generator is a place filters on its output do not pass.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [F.col(f"`{n}`") for n in rows.columns if n not in columns]
    return rows.select(*kept, F.inline(F.array(made)))


def parse_once(rows: DataFrame, text: str | Column, schema: str) -> DataFrame:
    """Add the fields of a JSON object held in ``text``; an unreadable text gives nulls."""
    return rows.select("*", F.inline(F.array(F.from_json(text, schema))))
