"""From report rows to detections with calendar columns, and the two row rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reddwatch import schemas
from reddwatch.functions.numeric import parse_number
from reddwatch.functions.predicates import is_member
from reddwatch.functions.text import first_word
from reddwatch.functions.times import parse_month_day_year, parse_obs_time, spawn_year
from reddwatch.operators.joins import lookup_join, unique_row_count
from reddwatch.params import ANY_SITE, SiteGroup

# A later batch supersedes an earlier one; within a batch the newest file does.
ARRIVAL = ["ingest_batch", "_source_time", "_source_file"]


def add_observation_calendar(observations: DataFrame) -> DataFrame:
    """Month, year and spawn year of the observation."""
    return observations.withColumns({
        "observation_month": F.month("observation_datetime"),
        "observation_year": F.year("observation_datetime"),
    }).withColumn(
        "spawn_year", spawn_year(F.col("observation_month"), F.col("observation_year"))
    )


def add_release_calendar(observations: DataFrame) -> DataFrame:
    """Release year and calendar years from release to observation."""
    return observations.withColumn("release_year", F.year("release_datetime")).withColumn(
        "yrs_at_large", F.col("observation_year") - F.col("release_year")
    )


def conform(report: DataFrame) -> DataFrame:
    """A raw report, all text, as detections; unreadable values become NULL."""
    header = schemas.REPORT_HEADERS
    # Columns the reader adds (file name, arrival) pass through.
    extra = [c for c in report.columns if c.startswith("_source")]
    parsed = report.select(
        F.col(header["tag"]).alias("pit_id"),
        F.col(header["rear_type"]).alias("rear_type"),
        first_word(F.col(header["release_site"])).alias("release_sitecode"),
        F.col(header["lifestage"]).alias("release_lifestage"),
        parse_month_day_year(F.col(header["release_date"])).alias("release_datetime"),
        first_word(F.col(header["site"])).alias("observation_sitecode"),
        parse_obs_time(F.col(header["obs_time"])).alias("observation_datetime"),
        parse_number(F.col(header["length"])).alias("length_mm"),
        *extra,
    )
    dated = add_release_calendar(add_observation_calendar(parsed))
    return dated.select(*schemas.DETECTIONS.fieldNames(), *extra)


def reject_counts(report: DataFrame) -> DataFrame:
    """One row: how many values of each parsed column hold text that could not be read."""
    return report.agg(*reject_columns())


def reject_columns() -> list[Column]:
    """The counts of `reject_counts`, for use while the report passes by."""
    header = schemas.REPORT_HEADERS

    def unread(name: str, value: Column) -> Column:
        return F.count_if(F.col(header[name]).isNotNull() & value.isNull())

    return [
        F.count(F.lit(1)).alias("n_rows"),
        unread("obs_time", parse_obs_time(F.col(header["obs_time"]))).alias("bad_obs_time"),
        unread("release_date", parse_month_day_year(F.col(header["release_date"])))
        .alias("bad_release_date"),
        # NaN is a missing length, not an unreadable one.
        unread("length", F.col(header["length"]).try_cast("double")).alias("bad_length"),
    ]


def add_most_recent(detections: DataFrame) -> DataFrame:
    """The latest spawn year of the whole table on every row, as a scalar subquery."""
    latest = detections.agg(F.max("spawn_year")).scalar()
    return detections.withColumn("most_recent", latest)


def latest_season(detections: DataFrame) -> DataFrame:
    """Rows of the latest spawn year. The scalar sees every row, before any other rule."""
    return add_most_recent(detections).filter(F.col("spawn_year") == F.col("most_recent"))


def drop_same_year_juveniles(detections: DataFrame) -> DataFrame:
    """Drop juveniles observed in the calendar year of their release."""
    return detections.filter(
        (F.col("yrs_at_large") != 0) | (F.col("release_lifestage") != "Juvenile")
    )


def current_detections(detections: DataFrame) -> DataFrame:
    """Detections of the latest spawn year without same-year juveniles."""
    return drop_same_year_juveniles(latest_season(detections))


def flag_sites(detections: DataFrame, group: SiteGroup) -> DataFrame:
    """Presence, entry and home-release flags for one site group.

    As in `flag_site_groups`, detections at a site that the group does not watch are left out, none
    if it takes all sites; `unmatched_sites` counts them.
    """
    if not group.all_sites:
        detections = detections.filter(is_member("observation_sitecode", group.watched))
    return detections.withColumns({
        "site_group": F.lit(group.name),
        "is_presence": is_member("observation_sitecode", group.presence),
        "is_entry": is_member("observation_sitecode", group.entry),
        "is_home_release": is_member("release_sitecode", group.home_release),
    })


def flag_site_groups(detections: DataFrame, site_groups: DataFrame) -> DataFrame:
    """The same flags for every group that watches a detection's site, one row per group."""
    group_rows = unique_row_count(site_groups, "site_group", "site_code")
    watched = _watched(site_groups)
    home = site_groups.filter("is_home_release").select(
        F.col("site_group").alias("_group"), F.col("site_code").alias("_home"),
        F.lit(True).alias("is_home_release"),
    )
    taking_all = _groups_of_all_sites(site_groups)
    listed = watched.filter(~F.col("site_group").isin(taking_all)) if taking_all else watched
    in_groups = lookup_join(
        detections, listed, [("observation_sitecode", "site_code")], how="inner",
        right_rows=group_rows, unique=False,
    )
    if taking_all:
        # A row for each such group, with the flags of the site if the group lists it.
        every = detections.withColumn(
            "site_group", F.explode(F.array(*[F.lit(g) for g in taking_all]))
        )
        listed_flags = watched.select(
            F.col("site_group").alias("_group"), "site_code", "is_presence", "is_entry"
        )
        every = lookup_join(
            every, listed_flags,
            [("site_group", "_group"), ("observation_sitecode", "site_code")],
            right_rows=group_rows,
        ).withColumns({c: F.coalesce(c, F.lit(False)) for c in ("is_presence", "is_entry")})
        others = site_groups.filter(~F.col("site_group").isin(taking_all)).isEmpty()
        in_groups = every if others else in_groups.unionByName(every)
    flagged = lookup_join(
        in_groups, home, [("site_group", "_group"), ("release_sitecode", "_home")],
        right_rows=group_rows,
    )
    return flagged.withColumn(
        "is_home_release", F.coalesce("is_home_release", F.lit(False))
    )


def unmatched_sites(detections: DataFrame, site_groups: DataFrame) -> DataFrame:
    """Detections that no group takes, counted by site and season."""
    if _groups_of_all_sites(site_groups):
        detections = detections.limit(0)
    sites = _watched(site_groups).select("site_code").distinct()
    left_out = lookup_join(
        detections, sites, [("observation_sitecode", "site_code")], how="left_anti"
    )
    return left_out.groupBy("observation_sitecode", "spawn_year").agg(
        F.count(F.lit(1)).alias("n")
    )


def _watched(site_groups: DataFrame) -> DataFrame:
    """Listed observation sites; rows of release sites have no presence flag."""
    return site_groups.filter(
        F.col("is_presence").isNotNull() & (F.col("site_code") != ANY_SITE)
    ).select("site_group", "site_code", "is_presence", "is_entry")


def _groups_of_all_sites(site_groups: DataFrame) -> list[str]:
    """Names of the groups that take all sites: settings, a short list."""
    rows = site_groups.filter(F.col("site_code") == ANY_SITE).select("site_group").distinct()
    return sorted(r[0] for r in rows.collect())


def newest_per_key(rows: DataFrame) -> DataFrame:
    """One row per detection, from its latest arrival; repeats in one file take the largest.

    Batch and ingest share it. Taking the maximum of a struct combines on the map side, so an often
    repeated detection does not gather in one task as it would under a ranking window.
    """
    arrival = [c for c in ARRIVAL if c in rows.columns]
    order = [*arrival, *schemas.DETECTION_PAYLOAD]
    rest = [c for c in rows.columns if c not in (*schemas.DETECTION_KEY, *order)]
    return (
        rows.groupBy(*schemas.DETECTION_KEY)
        .agg(F.max(F.struct(*order, *rest)).alias("_newest"))
        .select(*schemas.DETECTION_KEY, "_newest.*")
        .select(*rows.columns)
    )
