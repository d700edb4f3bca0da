"""Daily entries with running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reddwatch import schemas


def daily_entries(
    individuals: DataFrame, keys: Sequence[str] = ("spawn_year",)
) -> DataFrame:
    """Tags per last-entry date and their running share of the season.

    Tags without an entry form one group with a NULL date, last in the running order.
    """
    return with_running_totals(entry_counts(individuals, keys), keys)


def entry_counts(individuals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tags per last-entry date."""
    return (
        individuals.withColumn("yfk_final_date", F.to_date("yfk_entry_final"))
        .groupBy(*keys, "yfk_final_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def changed_entries(
    daily: DataFrame, old: DataFrame, new: DataFrame, keys: Sequence[str] = ("spawn_year",)
) -> DataFrame:
    """Daily entries after the individuals `old` have become `new`, from stored entries and these alone.

    What the old ones counted for is taken back, what the new ones count for added; dates that nothing is left
    of go, and the running totals follow from the dates.
    """
    taken = entry_counts(old, keys).withColumn("n", -F.col("n"))
    counts = (
        daily.select(*keys, "yfk_final_date", "n")
        .unionByName(entry_counts(new, keys)).unionByName(taken)
        .groupBy(*keys, "yfk_final_date").agg(F.sum("n").alias("n"))
        .filter(F.col("n") != 0)
    )
    return with_running_totals(counts, keys)


def with_running_totals(by_day: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per date with their running totals and shares.

    A season spans at most 366 dates, which bounds the rows each window task sorts.
    """
    season = W.partitionBy(*keys)
    so_far = season.orderBy(F.col("yfk_final_date").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    others = [k for k in keys if k != "spawn_year"]
    return (
        by_day
        .withColumns({
            "cumulative_total": F.sum("n").over(so_far),
            "sy_total": F.sum("n").over(season),
        })
        .withColumns({
            "daily_prop": F.col("n") / F.col("sy_total"),
            "daily_cumulative": F.col("cumulative_total") / F.col("sy_total"),
        })
        .select(*schemas.DAILY_COLUMNS, *others)
    )


def season_curves(daily: DataFrame, keys: Sequence[str] = ("spawn_year",)) -> DataFrame:
    """Running totals on every day of a season, for comparing seasons and groups day by day.

    A season runs from the first of July to the thirtieth of June. `season_day` counts a calendar day alike in
    all of them, from 1 to 366: the twenty-ninth of February has a number that only leap seasons use. Days
    without entries carry the total on, days before the first one have 0. Tags without an entry are on no
    day, but in the season's total.
    """
    year = F.col("spawn_year")
    first, last = F.make_date(year - 1, F.lit(7), F.lit(1)), F.make_date(year, F.lit(6), F.lit(30))
    days = daily.groupBy(*keys).agg(F.max("sy_total").alias("sy_total")).select(
        *keys, F.explode(F.sequence(first, last)).alias("date"), F.lit(0).cast("long").alias("n"), "sy_total"
    )
    entered = daily.filter(F.col("yfk_final_date").isNotNull()).select(
        *keys, F.col("yfk_final_date").alias("date"), "n", "sy_total"
    )
    by_day = days.unionByName(entered).groupBy(*keys, "date").agg(
        F.sum("n").alias("n"), F.max("sy_total").alias("sy_total")
    )
    so_far = W.partitionBy(*keys).orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    # The same day in the season of a leap year.
    alike = F.make_date(F.when(F.month("date") > 6, 1999).otherwise(2000), F.month("date"), F.day("date"))
    return by_day.withColumn("cumulative_total", F.sum("n").over(so_far)).select(
        *keys, (F.date_diff(alike, F.lit("1999-07-01").cast("date")) + 1).alias("season_day"), "date", "n",
        "cumulative_total", (F.col("cumulative_total") / F.col("sy_total")).alias("daily_cumulative"),
    )


def side_by_side(curves: DataFrame, seasons: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """A column of running totals for each of the given seasons, a row for each day of the common axis."""
    return (
        curves.groupBy(*keys, "season_day").pivot("spawn_year", list(seasons)).agg(F.max("cumulative_total"))
        .orderBy(*keys, "season_day")
    )
