"""Landed daily gauge readings, one row per site, date and parameter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reddwatch import schemas
from reddwatch.functions.times import within
from reddwatch.sources import tables


KEY = ["site_no", "date", "parameter_cd"]


def write_gauge(readings: DataFrame, path: str, landing: int | None = None) -> None:
    """Add a landing of readings to what is stored, by year.

    Nothing stored is removed: readers take the readings of the newest landing for each site, date
    and parameter. Landings are numbered in their order unless a number is given; writing a number
    again replaces that landing, so a replayed job changes nothing.
    """
    if landing is None:
        landing = next_landing(readings.sparkSession, path)
    (
        readings.withColumns({"year": F.year("date"), "landing": F.lit(landing).cast("long")})
        .hint("rebalance", "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "landing")
        .parquet(path)
    )


def next_landing(spark: SparkSession, path: str) -> int:
    """The number after the highest stored one; folder names tell it, no file is read."""
    stored = _stored(spark, path).agg(F.max("landing")).first()[0]
    return 0 if stored is None else stored + 1


def compact_gauge(spark: SparkSession, path: str, most: int = 1) -> list[int]:
    """Fold the landings of each year that has more than `most` into one, and give those years.

    The folded readings are a landing of their own, after all others, and have every site, date and parameter of
    the year, so readers see the same before, while and after the folded landings are emptied. A job that breaks
    off in between leaves them to the next one. Not to be run while a landing is added.
    """
    stored = _stored(spark, path)
    # Years and landings are folder names; a year's landings are few.
    found = stored.select("year", "landing").distinct().collect()
    landings: dict[int, list[int]] = {}
    for row in found:
        landings.setdefault(row.year, []).append(row.landing)
    years = sorted(y for y, numbers in landings.items() if len(numbers) > most)
    if not years:
        return []
    rows = stored.filter(F.col("year").isin(years))
    write_gauge(newest_landing(rows).drop("year"), path, next_landing(spark, path))
    none = spark.createDataFrame([], schemas.GAUGE_READINGS)
    for year in years:
        for number in landings[year]:
            none.write.mode("overwrite").parquet(f"{path}/year={year}/landing={number}")
    return years


def newest_landing(stored: DataFrame) -> DataFrame:
    """All readings that the newest landing has for a site, date and parameter.

    The newest numbers are one row per key after a map-side step, so a reading that was landed
    many times does not gather in one task.
    """
    newest = stored.groupBy(*KEY).agg(F.max("landing").alias("_newest"))
    newest = newest.select(*[F.col(c).alias(f"_{c}") for c in KEY], "_newest")
    same = F.col("landing") == F.col("_newest")
    for column in KEY:
        same = same & F.col(column).eqNullSafe(F.col(f"_{column}"))
    return stored.join(newest, same, "left_semi").drop("landing")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """Stored readings with year and landing; no rows if nothing is stored yet."""
    schema = T.StructType([
        *schemas.GAUGE_READINGS.fields,
        T.StructField("year", T.IntegerType()), T.StructField("landing", T.LongType()),
    ])
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_gauge(
    spark: SparkSession,
    path: str,
    sites: Iterable[str],
    parameters: Iterable[str],
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """The newest readings of the given sites, parameters and closed date range."""
    stored = _stored(spark, path).filter(
        F.col("year").between(min(first, last).year, max(first, last).year)
    )
    return newest_landing(select_readings(stored, sites, parameters, first, last)).drop("year")


def select_readings(
    readings: DataFrame,
    sites: Iterable[str],
    parameters: Iterable[str] | None,
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """Site, parameter (None for all) and date filters, all of which reach a Parquet scan."""
    chosen = F.col("site_no").isin(list(sites)) & within("date", first, last)
    if parameters is not None:
        chosen = chosen & F.col("parameter_cd").isin(list(parameters))
    return readings.filter(chosen)


def from_wide(wide: DataFrame, site_no: str, columns: dict[str, str]) -> DataFrame:
    """A feed with one column per parameter as long readings; `columns` maps name to code."""
    value_columns = list(columns)
    return (
        wide.withColumnRenamed("Date", "date")
        .select(F.col("date").cast("date").alias("date"), *value_columns)
        .unpivot("date", value_columns, "_column", "value")
        .select(
            F.lit(site_no).alias("site_no"),
            "date",
            F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])[
                F.col("_column")
            ].alias("parameter_cd"),
            "value",
        )
        .filter(F.col("value").isNotNull())
    )
