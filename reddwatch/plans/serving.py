"""Result sets behind each dashboard card.

`keys` are the columns that tell groups, or gauges, apart: every set carries them and counts per key.
Without keys a set is that of one group and season, or one gauge.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reddwatch.functions.numeric import bin_edges, round_half_even
from reddwatch.functions.text import joined, lifestage_colour, month_day, number_text
from reddwatch.functions.times import day, within
from reddwatch.operators.locations import with_coordinates
from reddwatch.params import (
    BIN_WIDTH,
    DISCHARGE_CAPTION,
    ENTERED_CAPTION,
    LABEL_X,
    MEAN_LABEL_Y,
    N_LABEL_Y,
    TEMPERATURE_CAPTION,
    TOTAL_CAPTION,
)

Day = dt.date | Column | None


def latest(table: DataFrame) -> DataFrame:
    """Rows of the latest stored season; the scalar prunes season folders."""
    return table.filter(F.col("spawn_year") == table.agg(F.max("spawn_year")).scalar())


def _tooltip(date: Column, caption: str, value: Column) -> Column:
    return joined(" Date:", date, "<br>", caption, value, sep=" ")


def _series(
    flow: DataFrame, value: str, caption: str, one: dt.date, other: dt.date, keys: Sequence[str]
) -> DataFrame:
    text = _tooltip(F.col("date"), caption, number_text(value))
    return (
        flow.filter(within("date", one, other))
        .select(*keys, "date", value, "group", text.alias("text"))
        .orderBy(*keys, "date")
    )


def discharge_series(
    flow: DataFrame, one: dt.date, other: dt.date, keys: Sequence[str] = ()
) -> DataFrame:
    return _series(flow, "mean_discharge", DISCHARGE_CAPTION, one, other, keys)


def temperature_series(
    flow: DataFrame, one: dt.date, other: dt.date, keys: Sequence[str] = ()
) -> DataFrame:
    return _series(flow, "mean_temp", TEMPERATURE_CAPTION, one, other, keys)


def total_text() -> Column:
    """The tooltip of a running total."""
    return _tooltip(
        month_day("yfk_final_date"), TOTAL_CAPTION,
        number_text(round_half_even("cumulative_total")),
    )


def year_to_date(
    daily: DataFrame, one: dt.date, other: dt.date, keys: Sequence[str] = ()
) -> DataFrame:
    """The running total inside a window; totals started before the window are kept."""
    return (
        daily.filter(within("yfk_final_date", one, other))
        .select(
            *keys, "yfk_final_date", "cumulative_total", "spawn_year", total_text().alias("text")
        )
        .orderBy(*keys, "spawn_year", "yfk_final_date")
    )


def entries_by_day(
    daily: DataFrame, one: dt.date, other: dt.date, keys: Sequence[str] = ()
) -> DataFrame:
    text = _tooltip(F.col("yfk_final_date"), ENTERED_CAPTION, F.col("n"))
    return (
        daily.filter(within("yfk_final_date", one, other))
        .select(*keys, "yfk_final_date", "n", "spawn_year", text.alias("text"))
        .orderBy(*keys, "spawn_year", "yfk_final_date")
    )


def length_bars(frequency: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    text = joined(
        "Length Bin: ", number_text("length_bin"), "<br>", "Number: ", F.col("freq")
    )
    return frequency.select(*keys, "length_bin", "freq", text.alias("text")).orderBy(
        *keys, "length_bin"
    )


def length_annotations(
    frequency: DataFrame, width: int = BIN_WIDTH, keys: Sequence[str] = ()
) -> DataFrame:
    """One row for each key: mean line, labels with their positions, and axis breaks."""
    return frequency.groupBy(*keys).agg(
        F.max("mean_length").alias("mean_length"),
        F.max("total_sample").alias("total_sample"),
        F.min("length_bin").alias("min_bin"),
        F.max("length_bin").alias("max_bin"),
        F.max("freq").alias("max_freq"),
    ).select(
        *keys,
        "mean_length",
        joined("N = ", F.col("total_sample")).alias("n_label"),
        joined(
            "Mean Length = ",
            joined(number_text(round_half_even("mean_length")), "mm", sep=" "),
        ).alias("mean_label"),
        (F.col("min_bin") * LABEL_X).alias("label_x"),
        (F.col("max_freq") * N_LABEL_Y).alias("n_label_y"),
        (F.col("max_freq") * MEAN_LABEL_Y).alias("mean_label_y"),
        bin_edges(F.col("min_bin"), F.col("max_bin"), width).alias("breaks"),
    )


def length_axis_breaks(
    frequency: DataFrame, width: int = BIN_WIDTH, keys: Sequence[str] = ()
) -> DataFrame:
    """The axis breaks one per row."""
    return length_annotations(frequency, width, keys).select(
        *keys, F.explode("breaks").alias("length_bin")
    )


def map_points(located: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Tags that can be drawn, with popup text and colour."""
    popup = joined(
        "<b>", "Site Code: ", "</b>", F.col("release_sitecode"),
        "<br>",
        "<b>", "Site Name: ", "</b>", F.col("site_name"),
    )
    return with_coordinates(located).select(
        *keys, "latitude", "longitude", "release_lifestage", "release_sitecode", "site_name",
        popup.alias("popup"),
        lifestage_colour("release_lifestage").alias("colour"),
    )


def unique_tags(individuals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Different tags of each key, or of all rows: a tag of several groups counts once there."""
    return individuals.select(*keys, "pit_id").distinct().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_tags")
    )


def entered_since(individuals: DataFrame, as_of: Day = None, days: int = 7) -> DataFrame:
    """Individuals whose last entry is at or after local midnight `days` before `as_of`."""
    start = F.date_sub(day(as_of), days).cast("timestamp")
    return individuals.filter(F.col("yfk_entry_final") >= start)


def new_in_last_week(
    individuals: DataFrame, as_of: Day = None, keys: Sequence[str] = ()
) -> DataFrame:
    return entered_since(individuals, as_of).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_new")
    )


def default_start(daily: DataFrame, weeks: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """First entry date less two weeks."""
    return daily.groupBy(*keys).agg(
        F.date_sub(F.min("yfk_final_date"), 7 * weeks).alias("date_start")
    )
