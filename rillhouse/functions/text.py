"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters up to U+0020 count as white space (SQL trim only removes spaces).
_WHITE = "".join(chr(i) for i in range(0x21))


def is_blank(c: Column) -> Column:
    """True for null and for text made only of characters up to U+0020."""
    return F.coalesce(~c.rlike(r"[^\x00-\x20]"), F.lit(True))


def trim_control(c: Column) -> Column:
    """Remove leading and trailing characters up to U+0020."""
    return F.btrim(c, F.lit(_WHITE))


def default_if_blank(c: Column, default: str) -> Column:
    return F.when(is_blank(c), F.lit(default)).otherwise(trim_control(c))


def equals_ignore_case(c: Column, word: str) -> Column:
    return F.coalesce(F.lower(c) == F.lit(word.lower()), F.lit(False))


def split_and_trim(c: Column) -> Column:
    """Comma list to array, entries trimmed and blanks skipped; blank list gives null."""
    parts = F.transform(F.split(c, ","), trim_control)
    return F.when(is_blank(c), F.lit(None)).otherwise(F.filter(parts, lambda x: x != F.lit("")))


def first_non_blank(a: Column, b: Column) -> Column:
    return F.when(is_blank(a.cast("string")), b).otherwise(a)


def string_max(a: Column, b: Column) -> Column:
    """Larger of two strings; a null side loses."""
    return F.greatest(a, b)


def clean_tsv_field(c: Column) -> Column:
    """Null becomes empty; tab, carriage return and newline become a space."""
    return F.coalesce(F.translate(c, "\t\r\n", "   "), F.lit(""))


def tsv_line(*fields: Column) -> Column:
    return F.concat_ws("\t", *[clean_tsv_field(f) for f in fields])
