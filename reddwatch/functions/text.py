"""Text: first word, joined labels, numbers and dates as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reddwatch.params import LIFESTAGE_COLOURS, OTHER_COLOUR


def first_word(text: Column | str) -> Column:
    """The part before the first space; the whole text if there is none."""
    return F.substring_index(text, " ", 1)


def joined(*parts: Column | str, sep: str = "") -> Column:
    """Parts in sequence with `sep` between them; NULL when any part is NULL.

    Strings are taken literally, columns are cast to text.
    """
    pieces: list[Column] = []
    for part in parts:
        if pieces and sep:
            pieces.append(F.lit(sep))
        pieces.append(F.lit(part) if isinstance(part, str) else part.cast("string"))
    return F.concat(*pieces)


def number_text(value: Column | str) -> Column:
    """A number with up to 15 significant digits and no trailing zeros (40.0 gives 40)."""
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    plain = F.regexp_replace(F.format_string("%.15g", value), r"\.?0+$", "")
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value == 0, F.lit("0"))
        .when((F.abs(value) >= 1e14) | (F.abs(value) < 1e-4), value.cast("string"))
        .otherwise(plain)
    )


def month_day(date: Column | str) -> Column:
    """Short label such as `Mar 09`."""
    return F.date_format(date, "MMM dd")


def lifestage_colour(stage: Column | str) -> Column:
    """Marker colour of a life stage."""
    stage = F.col(stage) if isinstance(stage, str) else stage
    colour = F.lit(OTHER_COLOUR)
    for name, shade in LIFESTAGE_COLOURS.items():
        colour = F.when(stage == name, F.lit(shade)).otherwise(colour)
    return colour
