"""Watch list of tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.operators.joins import lookup_join
from reddwatch.params import TAG_PATTERN


def well_formed(tags: DataFrame) -> DataFrame:
    return tags.filter(F.col("pit_id").rlike(TAG_PATTERN))


def malformed(tags: DataFrame) -> DataFrame:
    return tags.filter(~F.coalesce(F.col("pit_id").rlike(TAG_PATTERN), F.lit(False)))


def watch_list_hits(detections: DataFrame, tags: DataFrame) -> DataFrame:
    """Detections of tags on the list."""
    return lookup_join(detections, well_formed(tags), [("pit_id", "pit_id")], "left_semi")
