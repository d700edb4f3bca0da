"""Gauge readings as a daily flow and temperature series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reddwatch.functions.times import within
from reddwatch.params import DISCHARGE, TEMPERATURE


def daily_flow(
    readings: DataFrame, temperature: str = TEMPERATURE, discharge: str = DISCHARGE
) -> DataFrame:
    """One row per site and date; a parameter without a reading is NULL.

    Conditional means need one shuffle with a map-side step, where a pivot of the parameter
    column needs two. Several readings of a day average to the daily mean.
    """

    def mean_of(code: str) -> Column:
        return F.avg(F.when(F.col("parameter_cd") == code, F.col("value")))

    return (
        readings.filter(F.col("parameter_cd").isin(temperature, discharge))
        .groupBy("site_no", "date")
        .agg(
            mean_of(temperature).alias("mean_temp"),
            mean_of(discharge).alias("mean_discharge"),
        )
    )


def flow_range(flow: DataFrame, first: dt.date, last: dt.date | None) -> DataFrame:
    """Rows up to `last` or today, with the constant that draws them as one line."""
    return flow.filter(within("date", first, last)).withColumn("group", F.lit(1))
