"""Guarded number parsing.  Spark's casts trim blanks and accept type suffixes,
so the accepted spelling is checked before the cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillhouse.functions.text import is_blank

# The checks name their column as rarely as they can: each mention is a copy of the
# column's expression, and generated methods beyond a certain size are not compiled.

# fixed values: accepted spellings of whole numbers, of decimals, and of decimals or blanks
INTEGER_PATTERN = r"^[+-]?[0-9]+\z"
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"

BLANK_OR_DECIMAL_PATTERN = (r"^([\x00-\x20]*|[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)"
                            r"([eE][+-]?[0-9]+)?)\z")

# in-flight precision of money: 18 places are kept until the sum is rounded; window tables
# store decimal(16,2), and a single amount beyond that is no amount
AMOUNT_TYPE = "decimal(38,18)"
LARGEST_AMOUNT = "99999999999999.99"


def parse_integer(c: Column) -> Column:
    """64-bit integer, or null when the text is not one (no blanks, no fraction)."""
    return F.when(c.rlike(INTEGER_PATTERN), c.try_cast("bigint"))


def is_valid_integer(c: Column) -> Column:
    return parse_integer(c).isNotNull()


def parse_amount(c: Column) -> Column:
    """Decimal, blank counts as zero, null when the text is not a number or its amount is
    more than a window table holds."""
    amount = F.when(c.rlike(DECIMAL_PATTERN), c.try_cast(AMOUNT_TYPE))
    most = F.lit(LARGEST_AMOUNT).cast(AMOUNT_TYPE)
    return (F.when(is_blank(c), F.lit(0).cast(AMOUNT_TYPE))
            .when(F.abs(amount) <= most, amount))


def is_valid_amount(c: Column) -> Column:
    """Blank or a number of any size."""
    return F.coalesce(c.rlike(BLANK_OR_DECIMAL_PATTERN), F.lit(True))


def amount_or_zero(c: Column) -> Column:
    """Keep the original text, blank becomes the text ``0``."""
    return F.when(is_blank(c), F.lit("0")).otherwise(c)


def round_money(c: Column) -> Column:
    """Half-up to two places in the type of the window tables; null when it does not fit."""
    return F.round(c, 2).try_cast("decimal(16,2)")


def sum_whole(c: Column) -> Column:
    """Sum of 64-bit integers; null when it does not fit, never an error."""
    return F.sum(c.cast("decimal(38,0)")).try_cast("bigint")
