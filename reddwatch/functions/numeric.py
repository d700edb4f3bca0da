"""Numbers: safe parsing, bins, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reddwatch.params import BIN_WIDTH


def parse_number(text: Column | str) -> Column:
    """Text as a double; unreadable text and NaN are NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return without_nan(text.try_cast("double"))


def without_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def floor_bin(value: Column | str, width: float = BIN_WIDTH) -> Column:
    """Lower edge of the fixed-width bin a value falls in."""
    value = F.col(value) if isinstance(value, str) else value
    return (F.floor(value / width) * width).cast("double")


def round_half_even(value: Column | str) -> Column:
    return F.bround(value, 0)


def bin_edges(low: Column, high: Column, width: int = BIN_WIDTH) -> Column:
    """Edges from the lowest to the highest bin."""
    return F.sequence(low.cast("long"), high.cast("long"), F.lit(width).cast("long"))
