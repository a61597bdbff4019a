"""Number parsing and the two rounding rules of the source data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.text import strip

NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def to_number(col: Column) -> Column:
    """Double when the trimmed cell is a plain decimal number, else null ('4d' and 'inf' are not)."""
    value = strip(col)
    return F.when(value.rlike(NUMERIC), value.try_cast("double"))


def round_money(col: Column) -> Column:
    """Two decimals: scale, half-even on the scaled double, scale back (array rounding rule)."""
    return F.rint(col * 100) / 100


def round_tenth(col: Column) -> Column:
    """One decimal, half-even on the exact binary value (scalar rounding rule).

    ``col * 10`` may round onto a half that the exact product does not reach. 8x and 2x
    are exact, so what the sum lost is recovered exactly and settles such cases.
    """
    total = col * 10
    lost = col * 2 - (total - col * 8)
    low = F.floor(total)
    near_half = (total - low == 0.5) & (lost != 0)
    return F.when(near_half, low + (lost > 0).cast("int")).otherwise(F.rint(total)) / 10


def derived_total(total: Column, tip: Column, tip_percentage: Column) -> Column:
    """Fill a missing total from tip amount and tip percentage where both are positive."""
    return F.when(needs_total(total, tip, tip_percentage), round_money(tip / (tip_percentage / 100))).otherwise(total)


def needs_total(total: Column, tip: Column, tip_percentage: Column) -> Column:
    return F.coalesce(total.isNull() & (tip > 0) & (tip_percentage > 0), F.lit(False))
