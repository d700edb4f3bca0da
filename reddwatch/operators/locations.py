"""Release locations per tag, and their clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reddwatch.functions.numeric import floor_bin
from reddwatch.operators.joins import BROADCAST_ROWS, lookup_join, unique_row_count


def locations(
    tags: DataFrame,
    sites: DataFrame,
    keys: Sequence[str] = ("spawn_year",),
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Release site and life stage of every tag with the site's attributes.

    Tags under the juvenile rule stay in. Site codes must be unique.
    """
    attributes = [c for c in sites.columns if c != "site_code"]
    return lookup_join(
        tags.select("pit_id", "release_sitecode", "release_lifestage", *keys),
        sites,
        [("release_sitecode", "site_code")],
        max_broadcast_rows=max_broadcast_rows,
        right_rows=unique_row_count(sites, "site_code"),
    ).select("pit_id", "release_sitecode", "release_lifestage", *attributes, *keys)


def with_coordinates(located: DataFrame) -> DataFrame:
    """Rows that can be placed on a map."""
    return located.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def cluster_by_site(located: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Tags per release site and life stage."""
    return located.groupBy(
        *keys, "release_sitecode", "site_name", "latitude", "longitude", "release_lifestage"
    ).agg(F.count(F.lit(1)).alias("n_tags"))


def cluster_by_grid(located: DataFrame, cell: float, keys: Sequence[str] = ()) -> DataFrame:
    """Tags per grid cell and life stage; `cell` is the cell size in degrees."""
    return (
        with_coordinates(located)
        .groupBy(
            *keys,
            floor_bin("latitude", cell).alias("cell_latitude"),
            floor_bin("longitude", cell).alias("cell_longitude"),
            "release_lifestage",
        )
        .agg(F.count(F.lit(1)).alias("n_tags"))
    )


def cluster_pyramid(located: DataFrame, levels: int = 8, keys: Sequence[str] = ()) -> DataFrame:
    """Tags per cell of a quadtree at each level, with the mean place of a cell's tags.

    Level 0 is the whole world, and each level halves the cells of the one above both ways. The tags
    are counted once, in the cells of the finest level; those cells, with counts and sums of coordinates, are
    rolled up to all levels by leaving out the last bits of their numbers, so each level adds up to the ones below.
    """
    finest = levels - 1
    side = 1 << finest

    def number(degrees: str, low: float, span: float) -> Column:
        """The cell's number along an axis; the upper end belongs to the last cell."""
        return F.least(F.floor((F.col(degrees) - low) / span * side), F.lit(side - 1)).cast("long")

    cells = (
        with_coordinates(located)
        .groupBy(*keys, number("longitude", -180.0, 360.0).alias("x"), number("latitude", -90.0, 180.0).alias("y"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("latitude").alias("lat"), F.sum("longitude").alias("lon"))
    )
    level = F.explode(F.sequence(F.lit(0), F.lit(finest))).alias("level")
    # Two to the power of the levels left out.
    width = F.pow(F.lit(2), F.lit(finest) - F.col("level")).cast("long")
    return (
        cells.select("*", level)
        .groupBy(
            *keys, "level", F.floor(F.col("x") / width).cast("long").alias("cell_x"),
            F.floor(F.col("y") / width).cast("long").alias("cell_y"),
        )
        .agg(F.sum("n").alias("n_tags"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"))
        .select(
            *keys, "level", "cell_x", "cell_y", "n_tags", (F.col("lat") / F.col("n_tags")).alias("latitude"),
            (F.col("lon") / F.col("n_tags")).alias("longitude"),
        )
    )
