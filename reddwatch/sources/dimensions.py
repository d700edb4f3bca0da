"""Site table, site groups and watch list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reddwatch import schemas


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """The site dimension; a CSV file is bound to the declared schema, Parquet brings its own."""
    if path.endswith(".csv"):
        return (
            spark.read.schema(schemas.SITES)
            .options(header=True, nullValue="NA", enforceSchema=False)
            .csv(path)
        )
    return spark.read.parquet(path)


def sites_of(sites: DataFrame, codes: Iterable[str]) -> DataFrame:
    """The dimension rows of the given sites."""
    return sites.filter(F.col("site_code").isin(list(codes)))


def read_site_groups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SITE_GROUPS).parquet(path)


def read_watch_list(spark: SparkSession, path: str) -> DataFrame:
    """One tag per line, no header; blank lines are skipped."""
    return (
        spark.read.text(path)
        .select(F.trim("value").alias("pit_id"))
        .filter(F.col("pit_id") != "")
    )
