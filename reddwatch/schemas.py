"""Column names and schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Headers of the landed detection report, by the name they are stored under.
REPORT_HEADERS = {
    "tag": "Tag",
    "rear_type": "Rear Type Code",
    "release_site": "Release Site",
    "lifestage": "Mark Life Stage",
    "release_date": "Release Date",
    "site": "Site",
    "obs_time": "Obs Time",
    "length": "Mark Length",
}

DETECTIONS = T.StructType([
    T.StructField("pit_id", T.StringType()),
    T.StructField("rear_type", T.StringType()),
    T.StructField("release_sitecode", T.StringType()),
    T.StructField("release_lifestage", T.StringType()),
    T.StructField("release_datetime", T.DateType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("observation_sitecode", T.StringType()),
    T.StructField("observation_datetime", T.TimestampType()),
    T.StructField("observation_month", T.IntegerType()),
    T.StructField("observation_year", T.IntegerType()),
    T.StructField("yrs_at_large", T.IntegerType()),
    T.StructField("spawn_year", T.IntegerType()),
    T.StructField("length_mm", T.DoubleType()),
])

SITES = T.StructType([
    T.StructField("site_code", T.StringType()),
    T.StructField("site_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

GAUGE_READINGS = T.StructType([
    T.StructField("site_no", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("parameter_cd", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

SITE_GROUPS = T.StructType([
    T.StructField("site_group", T.StringType()),
    T.StructField("site_code", T.StringType()),
    T.StructField("is_presence", T.BooleanType()),
    T.StructField("is_entry", T.BooleanType()),
    T.StructField("is_home_release", T.BooleanType()),
])

# Columns of the saved tables, in order; keyed tables carry these plus their key columns.
INDIVIDUAL_COLUMNS = [
    "pit_id", "yfk_first", "yfk_entry_final", "yfk_diff", "length_mm",
    "release_lifestage", "release_sitecode", "release_datetime",
]
DAILY_COLUMNS = [
    "yfk_final_date", "n", "sy_total", "cumulative_total", "daily_prop",
    "daily_cumulative", "spawn_year",
]
FLOW_COLUMNS = ["date", "mean_temp", "mean_discharge", "group"]
LENGTH_COLUMNS = ["length_bin", "freq", "total_sample", "mean_length"]

# One detection is identified by these three; a repeat of them restates the same event.
DETECTION_KEY = ["pit_id", "observation_sitecode", "observation_datetime"]
DETECTION_PAYLOAD = [
    "rear_type", "release_sitecode", "release_lifestage", "release_datetime", "length_mm",
]
