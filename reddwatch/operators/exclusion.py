"""Juveniles released at home that were never seen downstream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.operators.joins import lookup_join


def distinct_tags(report: DataFrame) -> DataFrame:
    return report.select("pit_id").distinct()


def home_juvenile_tags(flagged: DataFrame) -> DataFrame:
    """Tags with a detection of a juvenile released at a home site."""
    return distinct_tags(
        flagged.filter((F.col("release_lifestage") == "Juvenile") & F.col("is_home_release"))
    )


def juveniles_not_downstream(flagged: DataFrame, downstream: DataFrame) -> DataFrame:
    """The exclusion set: home juveniles missing from the downstream report.

    Both sides are distinct before they meet, so no tag is hot in this join.
    """
    tags = home_juvenile_tags(flagged)
    seen = distinct_tags(downstream).withColumnRenamed("pit_id", "_seen")
    return tags.join(seen, F.col("pit_id").eqNullSafe(F.col("_seen")), "left_anti")


def exclude_tags(detections: DataFrame, excluded: DataFrame) -> DataFrame:
    """Detections whose tag is not in the set; a tag may hold any share of the rows.

    The set is counted before it is joined, so save it first if it is costly to compute.
    """
    return lookup_join(detections, excluded, [("pit_id", "pit_id")], "left_anti")


def drop_excluded_individuals(tags: DataFrame, downstream: DataFrame) -> DataFrame:
    """The same rule after the per-tag reduction, where each tag is one row.

    Joining here instead of before the reduction keeps the raw detections out of the join. The
    downstream tags are distinct, so a tag meets one row at most and the tags are read once.
    """
    seen = distinct_tags(downstream).select(
        F.col("pit_id").alias("_tag"), F.lit(True).alias("_seen")
    )
    marked = tags.join(seen, F.col("pit_id").eqNullSafe(F.col("_tag")), "left")
    return marked.filter(~F.col("home_juvenile") | F.col("_seen")).drop("_tag", "_seen")
