"""One row per tag: passage times, length and release attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reddwatch import schemas
from reddwatch.functions.numeric import without_nan
from reddwatch.functions.times import elapsed_days
from reddwatch.operators.exclusion import drop_excluded_individuals

SEASON = ("spawn_year",)
GROUP_SEASON = ("site_group", "spawn_year")
RELEASE = ["release_sitecode", "release_lifestage", "release_datetime"]


def tag_summary(flagged: DataFrame, keys: Sequence[str] = SEASON) -> DataFrame:
    """Reduce flagged detections to one row per `keys` and tag.

    The first step groups by tag and release attributes together, which nearly always is one
    row per tag: its aggregates are all fixed-width, so it runs as a hash aggregate with a
    map-side step and a tag with very many detections shrinks before the shuffle. The second
    step picks the attributes of the earliest detection from the few rows left; ties go to the
    smaller attribute values. Lengths are carried as sum and count.
    """
    time = F.col("observation_datetime")
    length = without_nan(F.col("length_mm"))  # Parquet sources may hold NaN
    partial = flagged.groupBy(*keys, "pit_id", *RELEASE).agg(
        F.min(time).alias("first_seen"),
        F.min(F.when(F.col("is_presence"), time)).alias("yfk_first"),
        F.max(F.when(F.col("is_entry"), time)).alias("yfk_entry_final"),
        F.sum(length).alias("length_sum"),
        F.count(length).alias("length_count"),
        F.max(_home_juvenile()).alias("home_juvenile"),
    )
    return _of_partial(partial, keys)


def _home_juvenile() -> Column:
    return F.col("is_home_release") & (F.col("release_lifestage") == "Juvenile")


def tag_cells(detections: DataFrame) -> DataFrame:
    """Detections reduced to one row per season, tag, release attributes and observation site.

    Flags of a site group depend on these columns alone, so `flag_site_groups` can take cells in place of
    detections: what a tag leaves at a site, however often, meets the groups once. All aggregates have fixed
    width and a map-side step.
    """
    time = F.col("observation_datetime")
    length = without_nan(F.col("length_mm"))
    return detections.groupBy("spawn_year", "pit_id", *RELEASE, "observation_sitecode").agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        F.sum(length).alias("length_sum"), F.count(length).alias("length_count"),
    )


def cell_summary(flagged: DataFrame, keys: Sequence[str] = SEASON) -> DataFrame:
    """`tag_summary` of flagged cells."""
    partial = flagged.select(
        *keys, "pit_id", *RELEASE, F.col("first_time").alias("first_seen"),
        F.when(F.col("is_presence"), F.col("first_time")).alias("yfk_first"),
        F.when(F.col("is_entry"), F.col("last_time")).alias("yfk_entry_final"),
        "length_sum", "length_count", _home_juvenile().alias("home_juvenile"),
    )
    return _of_partial(partial, keys)


def _of_partial(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per `keys` and tag of rows that each stand for some of its detections."""
    return (
        partial.groupBy(*keys, "pit_id")
        .agg(
            F.min(F.struct("first_seen", *RELEASE)).alias("_earliest"),
            F.min("yfk_first").alias("yfk_first"),
            F.max("yfk_entry_final").alias("yfk_entry_final"),
            F.sum("length_sum").alias("length_sum"),
            F.sum("length_count").alias("length_count"),
            F.coalesce(F.max("home_juvenile"), F.lit(False)).alias("home_juvenile"),
        )
        .select(
            *keys, "pit_id", "_earliest.first_seen",
            *[F.col(f"_earliest.{c}").alias(c) for c in RELEASE],
            "yfk_first", "yfk_entry_final", "length_sum", "length_count", "home_juvenile",
        )
    )


def individuals(
    tags: DataFrame, downstream: DataFrame, keys: Sequence[str] = SEASON
) -> DataFrame:
    """Tags kept by the juvenile rule, with time between first passage and last entry."""
    zoned = not isinstance(tags.schema["yfk_first"].dataType, T.TimestampNTZType)
    return (
        drop_excluded_individuals(tags, downstream)
        .withColumns({
            "yfk_diff": elapsed_days("yfk_first", "yfk_entry_final", zoned),
            "length_mm": F.when(
                F.col("length_count") > 0, F.col("length_sum") / F.col("length_count")
            ),
        })
        .select(*schemas.INDIVIDUAL_COLUMNS, *keys)
    )


def release_info(flagged: DataFrame) -> DataFrame:
    """Release site and date of each tag's earliest detection."""
    return tag_summary(flagged, keys=()).select("pit_id", "release_sitecode", "release_datetime")


def attach_release_info(passages: DataFrame, info: DataFrame) -> DataFrame:
    """Release site and date joined to per-tag rows; both sides hold a tag once.

    `individuals` gets these columns from one aggregate and needs no such join.
    """
    info = info.withColumnRenamed("pit_id", "_info_tag")
    return passages.join(info, F.col("pit_id").eqNullSafe(F.col("_info_tag")), "left").drop(
        "_info_tag"
    )
