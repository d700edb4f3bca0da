"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reddwatch import schemas
from reddwatch.checks import tables as t
from reddwatch.functions.times import elapsed_days, parse_obs_time
from reddwatch.operators import detections as det
from reddwatch.operators import gauges, lengths, watch
from reddwatch.operators.daily import daily_entries
from reddwatch.operators.daily import season_curves as curves_of
from reddwatch.operators.exclusion import (
    distinct_tags,
    exclude_tags,
    home_juvenile_tags,
    juveniles_not_downstream,
)
from reddwatch.operators.locations import cluster_by_grid, cluster_by_site, locations
from reddwatch.operators.locations import cluster_pyramid as pyramid_of
from reddwatch.operators.passage import (
    GROUP_SEASON,
    attach_release_info,
    individuals,
    release_info,
    tag_summary,
)
from reddwatch.params import DISCHARGE, TEMPERATURE, ZONE, site_group_table
from reddwatch.plans import batch, serving
from reddwatch.session import workspace
from reddwatch.sources import dimensions, published, reports
from reddwatch.sources import gauges as gauge_files
from reddwatch.sources import tables as saved
from reddwatch.streaming.ingest import compact_log, current_log, ingest, landed_reader

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = (dt.date(2024, 1, 20), dt.date(2024, 1, 10))
ENTRY_WINDOW = (dt.date(2001, 7, 10), dt.date(2001, 7, 25))
GAUGE_AS_OF = dt.date(2024, 1, 30)
DETECTION_OUT = [
    "pit_id", "release_sitecode", "release_lifestage", "release_datetime",
    "observation_sitecode", "observation_datetime", "yrs_at_large", "spawn_year", "length_mm",
]


# Shared steps.

def _current(spark: SparkSession, sf: str) -> DataFrame:
    latest = det.drop_same_year_juveniles(t.latest_detections(spark, sf))
    return det.flag_sites(latest, t.REPORT_A)


def _all_years(spark: SparkSession, sf: str) -> DataFrame:
    return det.flag_sites(
        det.drop_same_year_juveniles(t.detections(spark, sf)), t.REPORT_A
    )


def _individuals(spark: SparkSession, sf: str) -> DataFrame:
    return individuals(tag_summary(_current(spark, sf)), t.downstream(spark, sf))


def _yearly_individuals(spark: SparkSession, sf: str) -> DataFrame:
    return individuals(tag_summary(_all_years(spark, sf)), t.downstream(spark, sf))


def _groups(spark: SparkSession) -> DataFrame:
    return site_group_table(spark, [t.GROUP_A, t.GROUP_B])


def _group_tags(spark: SparkSession, sf: str) -> DataFrame:
    return batch.group_season_tags(t.detections(spark, sf), _groups(spark))


def _group_individuals(spark: SparkSession, sf: str) -> DataFrame:
    return individuals(_group_tags(spark, sf), t.downstream(spark, sf), GROUP_SEASON)


def _locations(spark: SparkSession, sf: str) -> DataFrame:
    return locations(tag_summary(_current(spark, sf)), t.sites(spark, sf))


def _yearly_locations(spark: SparkSession, sf: str) -> DataFrame:
    return locations(tag_summary(_all_years(spark, sf)), t.sites(spark, sf))


def _flow(spark: SparkSession, sf: str) -> DataFrame:
    wide = gauges.daily_flow(
        t.readings(spark, sf), t.TEMPERATURE_EVENT, t.DISCHARGE_EVENT
    )
    return t.rounded(wide, "mean_temp", "mean_discharge")


def _flow_line(spark: SparkSession, sf: str) -> DataFrame:
    return gauges.flow_range(_flow(spark, sf), dt.date(2024, 1, 1), GAUGE_AS_OF)


def _entries_out(daily: DataFrame) -> DataFrame:
    return t.as_longs(t.rounded(daily, "daily_prop", "daily_cumulative", digits=6))


def _individuals_out(kept: DataFrame) -> DataFrame:
    return t.as_longs(t.rounded(kept, "length_mm", "yfk_diff"))


# Sources.

def report_scan(
    spark: SparkSession, sf: str, line_breaks: bool | str = True, land=t.land_report
) -> DataFrame:
    report = reports.read_report(spark, land(spark, sf), line_breaks=line_breaks)
    return t.as_longs(
        det.conform(report).withColumn(
            "observation_datetime", F.col("observation_datetime").cast("timestamp_ntz")
        )
    )


def report_scan_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same files, split at line ends."""
    return report_scan(spark, sf, line_breaks=False)


def report_scan_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose fields hold line breaks, read block by block."""
    return report_scan(spark, sf, line_breaks=reports.BLOCKS, land=t.land_report_with_notes)


def zoned_passage(spark: SparkSession, sf: str) -> DataFrame:
    """Times as a report writes them, read in its zone: first and last day of a user and the days between, which
    hold the hour that is left out in spring."""
    local = spark.newSession()
    local.conf.set("spark.sql.session.timeZone", ZONE)
    seen = t.table(local, sf, "events").select(
        "user_id",
        parse_obs_time(
            F.date_format(F.col("ts") + F.expr("interval 62 days"), "MM/dd/yyyy hh:mm:ss a")
        ).alias("time"),
    )
    return seen.groupBy("user_id").agg(F.min("time").alias("first"), F.max("time").alias("last")).select(
        "user_id", F.to_date("first").alias("first_date"), F.to_date("last").alias("last_date"),
        F.round(elapsed_days("first", "last"), 8).alias("yfk_diff"),
    )


def downstream_scan(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_tags(reports.read_downstream(spark, t.land_downstream(spark, sf)))


def report_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return det.reject_counts(reports.read_report(spark, t.land_report(spark, sf)))


def sites_scan(spark: SparkSession, sf: str) -> DataFrame:
    folder = workspace(spark, "sites") + ".csv"
    t.sites(spark, sf).write.options(header=True, nullValue="NA").csv(folder)
    return dimensions.read_sites(spark, folder)


def sites_of_group(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.sites_of(t.sites(spark, sf), t.GROUP_A.home_release)


def gauge_scan(spark: SparkSession, sf: str) -> DataFrame:
    folder = workspace(spark, "gauge")
    gauge_files.write_gauge(t.readings(spark, sf), folder)
    return _readings_out(_chosen(spark, folder, ["G"]))


def _chosen(spark: SparkSession, folder: str, sites: list[str]) -> DataFrame:
    return gauge_files.read_gauge(
        spark, folder, sites, [t.TEMPERATURE_EVENT, t.DISCHARGE_EVENT], *WINDOW
    )


def _readings_out(chosen: DataFrame) -> DataFrame:
    return chosen.groupBy("site_no", "date", "parameter_cd").agg(
        F.count(F.lit(1)).alias("n_readings"), F.round(F.sum("value"), 4).alias("total")
    )


def gauge_landed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Readings landed by site and by day, with a first landing that is restated: none is lost."""
    folder = workspace(spark, "gauge")
    _land_twice(spark, sf, folder)
    return _readings_out(_chosen(spark, folder, ["G", "H"]))


def _land_twice(spark: SparkSession, sf: str, folder: str) -> None:
    one, other = t.readings(spark, sf), t.readings(spark, sf).withColumn("site_no", F.lit("H"))
    early = F.col("date") < dt.date(2024, 1, 15)
    gauge_files.write_gauge(one.filter(early).withColumn("value", F.col("value") + 1), folder)
    gauge_files.write_gauge(other.filter(early), folder)
    gauge_files.write_gauge(one.filter(~early).unionByName(other.filter(~early)), folder)
    gauge_files.write_gauge(one.filter(early), folder)


def gauge_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The same landings, folded into one before they are read."""
    folder = workspace(spark, "gauge")
    _land_twice(spark, sf, folder)
    gauge_files.compact_gauge(spark, folder)
    return _readings_out(_chosen(spark, folder, ["G", "H"]))


def gauge_wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = _flow(spark, sf).withColumnRenamed("date", "Date")
    return gauge_files.from_wide(
        wide, "G", {"mean_temp": t.TEMPERATURE_EVENT, "mean_discharge": t.DISCHARGE_EVENT}
    )


def watch_list_hits(spark: SparkSession, sf: str) -> DataFrame:
    listed = dimensions.read_watch_list(spark, t.land_watch_list(spark, sf))
    tagged = t.detections(spark, sf).withColumn("pit_id", t.tag_code(F.col("pit_id")))
    return t.as_longs(watch.watch_list_hits(tagged, listed).select(*DETECTION_OUT))


def watch_list_malformed(spark: SparkSession, sf: str) -> DataFrame:
    return watch.malformed(dimensions.read_watch_list(spark, t.land_watch_list(spark, sf)))


# Detections and the juvenile rule.

def detections_all(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        t.detections(spark, sf).select(
            *DETECTION_OUT, "release_year", "observation_month", "observation_year"
        )
    )


def most_recent_year(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        det.add_most_recent(t.detections(spark, sf))
        .groupBy("spawn_year", "most_recent")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def detections_current(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        det.current_detections(t.detections(spark, sf)).select(*DETECTION_OUT, "most_recent")
    )


def same_year_juveniles_dropped(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        det.drop_same_year_juveniles(t.detections(spark, sf)).select(*DETECTION_OUT)
    )


def site_flags(spark: SparkSession, sf: str) -> DataFrame:
    return (
        det.flag_sites(t.detections(spark, sf), t.REPORT_A)
        .groupBy("observation_sitecode", "release_sitecode",
                 "is_presence", "is_entry", "is_home_release")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def site_group_flags(spark: SparkSession, sf: str) -> DataFrame:
    return (
        det.flag_site_groups(t.detections(spark, sf), _groups(spark))
        .groupBy("site_group", "observation_sitecode", "release_sitecode",
                 "is_presence", "is_entry", "is_home_release")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def unmatched_sites(spark: SparkSession, sf: str) -> DataFrame:
    groups = site_group_table(spark, [t.GROUP_A])
    return t.as_longs(det.unmatched_sites(t.detections(spark, sf), groups))


def home_juveniles(spark: SparkSession, sf: str) -> DataFrame:
    return home_juvenile_tags(_current(spark, sf))


def juvenile_not_downstream(spark: SparkSession, sf: str) -> DataFrame:
    return juveniles_not_downstream(_current(spark, sf), t.downstream(spark, sf))


def detections_kept(spark: SparkSession, sf: str) -> DataFrame:
    current = _current(spark, sf)
    excluded = juveniles_not_downstream(current, t.downstream(spark, sf))
    return t.as_longs(exclude_tags(current, excluded).select(*DETECTION_OUT))


# Individuals, daily entries, locations, lengths.

def tag_first_release(spark: SparkSession, sf: str) -> DataFrame:
    return release_info(_all_years(spark, sf))


def individuals_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _individuals_out(_individuals(spark, sf))


def individuals_joined(spark: SparkSession, sf: str) -> DataFrame:
    passages = _individuals(spark, sf).drop("release_sitecode", "release_datetime")
    joined_rows = attach_release_info(passages, release_info(_current(spark, sf)))
    return _individuals_out(joined_rows.select(*schemas.INDIVIDUAL_COLUMNS, "spawn_year"))


def individuals_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return _individuals_out(_group_individuals(spark, sf))


def entry_daily_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    return _entries_out(daily_entries(_individuals(spark, sf)))


def entry_daily_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return _entries_out(daily_entries(_yearly_individuals(spark, sf)))


def entry_daily_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return _entries_out(daily_entries(_group_individuals(spark, sf), GROUP_SEASON))


def locations_latest(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(_locations(spark, sf))


def locations_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        locations(_group_tags(spark, sf), t.sites(spark, sf), GROUP_SEASON)
    )


def site_lifestage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(cluster_by_site(_yearly_locations(spark, sf), ["spawn_year"]))


def grid_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return cluster_by_grid(_yearly_locations(spark, sf), 5.0)


def cluster_pyramid(spark: SparkSession, sf: str) -> DataFrame:
    pyramid = pyramid_of(_yearly_locations(spark, sf), levels=8)
    return t.as_longs(t.rounded(pyramid, "latitude", "longitude", digits=6))


def length_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return t.rounded(
        lengths.length_frequency(t.measured_parts(spark, sf)), "mean_length"
    )


def length_frequency_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        t.rounded(
            lengths.length_frequency(_group_individuals(spark, sf), GROUP_SEASON),
            "mean_length",
        )
    )


# Gauges.

def gauge_daily_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _flow(spark, sf)


def gauge_sites_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = gauges.daily_flow(
        t.readings(spark, sf, F.col("user_id")), t.TEMPERATURE_EVENT, t.DISCHARGE_EVENT
    )
    return t.rounded(wide, "mean_temp", "mean_discharge")


def flow_range(spark: SparkSession, sf: str) -> DataFrame:
    flow = gauges.flow_range(_flow(spark, sf), dt.date(2024, 1, 5), dt.date(2024, 1, 25))
    return t.as_longs(flow.select(*schemas.FLOW_COLUMNS))


def series_window(spark: SparkSession, sf: str) -> DataFrame:
    return gauge_files.select_readings(t.readings(spark, sf), ["G"], None, *WINDOW)


def flow_by_site(spark: SparkSession, sf: str) -> DataFrame:
    """The flow table of several gauges."""
    named = t.readings(spark, sf, F.col("user_id")).replace(
        {t.TEMPERATURE_EVENT: TEMPERATURE, t.DISCHARGE_EVENT: DISCHARGE}, subset="parameter_cd"
    )
    flow = batch.flow_table(named, GAUGE_AS_OF, dt.date(2024, 1, 1), batch.GAUGE)
    return t.as_longs(t.rounded(flow, "mean_temp", "mean_discharge"))


# Served result sets.


def discharge_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Places of the days in each gauge's series, in the order in which it is served."""
    served = serving.discharge_series(flow_by_site(spark, sf), *WINDOW, keys=["site_no"])
    return t.as_longs(t.in_order(served.drop("text", "group"), "site_no"))


def entries_until_today(spark: SparkSession, sf: str) -> DataFrame:
    """Running totals from a day up to the current date, numbered as they are served."""
    daily = daily_entries(_yearly_individuals(spark, sf))
    served = serving.year_to_date(daily, dt.date(1998, 3, 1), None)
    return t.as_longs(t.in_order(served.drop("text"), "spawn_year"))

def discharge_series(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(serving.discharge_series(_flow_line(spark, sf), *WINDOW))


def temperature_series(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(serving.temperature_series(_flow_line(spark, sf), *WINDOW))


def year_to_date(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        serving.year_to_date(daily_entries(_individuals(spark, sf)), *ENTRY_WINDOW)
    )


def entries_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        serving.entries_by_day(daily_entries(_individuals(spark, sf)), *ENTRY_WINDOW)
    )


def tooltip_text(spark: SparkSession, sf: str) -> DataFrame:
    daily = daily_entries(_yearly_individuals(spark, sf))
    return t.as_longs(
        daily.select(
            "spawn_year", "yfk_final_date",
            serving.total_text().alias("text"),
        )
    )


def length_bars(spark: SparkSession, sf: str) -> DataFrame:
    return serving.length_bars(lengths.length_frequency(t.measured_parts(spark, sf)))


def length_annotations(spark: SparkSession, sf: str) -> DataFrame:
    notes = serving.length_annotations(lengths.length_frequency(t.measured_parts(spark, sf)))
    return t.rounded(
        notes.drop("breaks"), "mean_length", "label_x", "n_label_y", "mean_label_y"
    )


def bin_edges(spark: SparkSession, sf: str) -> DataFrame:
    return serving.length_axis_breaks(lengths.length_frequency(t.measured_parts(spark, sf)))


def map_points(spark: SparkSession, sf: str) -> DataFrame:
    return serving.map_points(_yearly_locations(spark, sf))


def unique_tags(spark: SparkSession, sf: str) -> DataFrame:
    return serving.unique_tags(_individuals(spark, sf))


def new_in_last_week(spark: SparkSession, sf: str) -> DataFrame:
    return serving.new_in_last_week(_individuals(spark, sf), dt.date(2001, 7, 31))


def trailing_week(spark: SparkSession, sf: str) -> DataFrame:
    entered = t.table(spark, sf, "events").withColumnRenamed("ts", "yfk_entry_final")
    return serving.new_in_last_week(entered, GAUGE_AS_OF)


def default_start(spark: SparkSession, sf: str) -> DataFrame:
    return serving.default_start(daily_entries(_individuals(spark, sf)))


def default_start_by_gauge(spark: SparkSession, sf: str) -> DataFrame:
    days = t.readings(spark, sf).withColumnRenamed("date", "yfk_final_date")
    return serving.default_start(days)


# The same sets of every group and season.

def _group_daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_entries(_group_individuals(spark, sf), GROUP_SEASON)


def year_to_date_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(
        serving.year_to_date(_group_daily(spark, sf), *ENTRY_WINDOW, keys=["site_group"])
    )


def unique_tags_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(serving.unique_tags(_group_individuals(spark, sf), GROUP_SEASON))


def unique_tags_all_groups(spark: SparkSession, sf: str) -> DataFrame:
    return serving.unique_tags(_group_individuals(spark, sf))


def length_bars_by_group(spark: SparkSession, sf: str) -> DataFrame:
    frequency = lengths.length_frequency(_group_individuals(spark, sf), GROUP_SEASON)
    return t.as_longs(serving.length_bars(frequency, GROUP_SEASON))


def map_points_by_group(spark: SparkSession, sf: str) -> DataFrame:
    located = locations(_group_tags(spark, sf), t.sites(spark, sf), GROUP_SEASON)
    return t.as_longs(serving.map_points(located, GROUP_SEASON))


def season_curves(spark: SparkSession, sf: str) -> DataFrame:
    """Every group's seasons on one axis of days."""
    curves = curves_of(_group_daily(spark, sf), GROUP_SEASON)
    return t.as_longs(t.rounded(curves, "daily_cumulative", digits=6))


def default_start_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(serving.default_start(_group_daily(spark, sf), keys=GROUP_SEASON))


# Saved tables and incremental ingest.

def _store(spark: SparkSession, purpose: str) -> batch.Store:
    return batch.Store(workspace(spark, purpose))


def _saved(spark: SparkSession, sf: str) -> batch.Store:
    store = _store(spark, "saved")
    batch.save_detections(
        t.detections(spark, sf), _groups(spark), t.downstream(spark, sf), t.sites(spark, sf),
        store,
    )
    return store


def _published(spark: SparkSession, store: batch.Store, name: str) -> DataFrame:
    return published.read(spark, store.root, name)


def saved_individuals(spark: SparkSession, sf: str) -> DataFrame:
    stored = _published(spark, _saved(spark, sf), "individuals")
    return _individuals_out(serving.latest(stored))


def saved_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _entries_out(_published(spark, _saved(spark, sf), "daily"))


def saved_locations(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(_published(spark, _saved(spark, sf), "locations"))


def published_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Entries per day as published, after a later run has broken off between two tables."""
    store = _saved(spark, sf)
    state = published.State.newest(spark, store.root)
    run = published.Run(spark, store.root)
    some = state.table("tags").filter("pit_id % 2 = 0")
    run.save("individuals", individuals(run.save("tags", some), t.downstream(spark, sf), GROUP_SEASON))
    return _entries_out(_published(spark, store, "daily"))


def saved_flow(spark: SparkSession, sf: str) -> DataFrame:
    path = _store(spark, "flow").path("flow")
    return t.as_longs(
        saved.save_table(_flow_line(spark, sf).select(*schemas.FLOW_COLUMNS), path)
    )


def saved_series_window(spark: SparkSession, sf: str) -> DataFrame:
    """A date window served from a saved table that is laid out by date."""
    path = _store(spark, "series").path("flow")
    flow = saved.save_table(_flow_line(spark, sf).select(*schemas.FLOW_COLUMNS), path, cluster=["date"])
    return t.as_longs(serving.discharge_series(flow, *WINDOW))


def season_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """All seasons saved, then the latest one saved again: the others stay."""
    path = _store(spark, "overwrite").path("daily")
    saved.save_seasons(daily_entries(_yearly_individuals(spark, sf)), path)
    return _entries_out(
        saved.save_seasons(daily_entries(_individuals(spark, sf)), path)
    )


def _ingested(
    spark: SparkSession, sf: str, folder: str | None = None, compact: bool = False
) -> batch.Store:
    """The orders table, or files of a folder one at a time, taken in."""
    store = _store(spark, "ingest")
    reader = spark.readStream.schema(t.TABLE_SCHEMAS["orders"])
    if folder is None:
        reader = reader.option("pathGlobFilter", "orders.parquet")
    else:
        reader = reader.option("maxFilesPerTrigger", 1)
    landed = reader.parquet(folder or sf).select(
        "*",
        F.col("_metadata.file_modification_time").alias("_source_time"),
        F.col("_metadata.file_path").alias("_source_file"),
    )
    ingest(
        spark, landed, lambda rows: t.with_marks(t.observations(rows), t.marks(spark, sf)),
        store,
        _groups(spark), t.downstream(spark, sf), t.sites(spark, sf),
    )
    if compact:
        compact_log(spark, store)
    return store


def incremental_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _entries_out(_published(spark, _ingested(spark, sf), "daily"))


def incremental_detections(spark: SparkSession, sf: str) -> DataFrame:
    return t.as_longs(current_log(spark, _ingested(spark, sf)).select(*DETECTION_OUT))


def incremental_restated(spark: SparkSession, sf: str) -> DataFrame:
    """A file with wrong life stages, one that restates them and one that repeats; then compacted."""
    orders = t.table(spark, sf, "orders")
    wrong = F.col("o_custkey") % 5 == 0
    turned = orders.withColumn(
        "o_orderstatus", F.when(wrong, "?").otherwise(F.col("o_orderstatus"))
    )
    folder = t.land_parts(
        spark, [turned, orders.filter(wrong), orders.filter("o_custkey % 2 = 0")], "restated"
    )
    store = _ingested(spark, sf, folder, compact=True)
    return t.as_longs(current_log(spark, store).select(*DETECTION_OUT))


def incremental_late(spark: SparkSession, sf: str) -> DataFrame:
    """Entries per day after a file with the later orders and then one with the earlier ones."""
    orders = t.table(spark, sf, "orders")
    late = F.dayofmonth("o_orderdate") < 10
    folder = t.land_parts(spark, [orders.filter(~late), orders.filter(late)], "late")
    return _entries_out(_published(spark, _ingested(spark, sf, folder), "daily"))


def _mixed(spark: SparkSession, sf: str) -> batch.Store:
    """Reports of several shapes in one landing folder, with stray files among them, taken in."""
    store = _store(spark, "mixed")
    seen = t.downstream(spark, sf).select(t.tag_code(F.col("pit_id")).alias("pit_id"))
    ingest(
        spark, reports.stream_files(spark, t.land_mixed_reports(spark, sf)), det.conform, store,
        _groups(spark), seen, t.sites(spark, sf), read=landed_reader(spark),
    )
    return store


def incremental_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """The log after a landing of reports of several shapes."""
    logged = current_log(spark, _mixed(spark, sf)).select(*DETECTION_OUT)
    return t.as_longs(
        logged.withColumn("observation_datetime", F.col("observation_datetime").cast("timestamp_ntz"))
    )


def reports_set_aside(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a landing that are no reports: their header and how many rows they hold."""
    _, aside = reports.read_landed(spark, t.land_mixed_reports(spark, sf))
    return aside.groupBy("header").agg(F.sum(F.col("n_lines") - 1).alias("n_rows"))


QUERIES: dict[str, Query] = {
    "report_scan": report_scan,
    "report_scan_split": report_scan_split,
    "report_scan_blocks": report_scan_blocks,
    "zoned_passage": zoned_passage,
    "discharge_in_order": discharge_in_order,
    "entries_until_today": entries_until_today,
    "downstream_scan": downstream_scan,
    "report_rejects": report_rejects,
    "sites_scan": sites_scan,
    "sites_of_group": sites_of_group,
    "gauge_scan": gauge_scan,
    "gauge_landed_twice": gauge_landed_twice,
    "gauge_wide_to_long": gauge_wide_to_long,
    "watch_list_hits": watch_list_hits,
    "watch_list_malformed": watch_list_malformed,
    "detections_all": detections_all,
    "most_recent_year": most_recent_year,
    "detections_current": detections_current,
    "same_year_juveniles_dropped": same_year_juveniles_dropped,
    "site_flags": site_flags,
    "site_group_flags": site_group_flags,
    "unmatched_sites": unmatched_sites,
    "home_juveniles": home_juveniles,
    "juvenile_not_downstream": juvenile_not_downstream,
    "detections_kept": detections_kept,
    "tag_first_release": tag_first_release,
    "individuals": individuals_latest,
    "individuals_joined": individuals_joined,
    "individuals_by_group": individuals_by_group,
    "entry_daily_cumulative": entry_daily_cumulative,
    "entry_daily_by_year": entry_daily_by_year,
    "entry_daily_by_group": entry_daily_by_group,
    "locations": locations_latest,
    "locations_by_group": locations_by_group,
    "site_lifestage_counts": site_lifestage_counts,
    "grid_clusters": grid_clusters,
    "length_frequency": length_frequency,
    "length_frequency_by_group": length_frequency_by_group,
    "gauge_daily_wide": gauge_daily_wide,
    "gauge_sites_wide": gauge_sites_wide,
    "flow_range": flow_range,
    "series_window": series_window,
    "flow_by_site": flow_by_site,
    "discharge_series": discharge_series,
    "temperature_series": temperature_series,
    "year_to_date": year_to_date,
    "entries_by_day": entries_by_day,
    "tooltip_text": tooltip_text,
    "length_bars": length_bars,
    "length_annotations": length_annotations,
    "bin_edges": bin_edges,
    "map_points": map_points,
    "unique_tags": unique_tags,
    "new_in_last_week": new_in_last_week,
    "trailing_week": trailing_week,
    "default_start": default_start,
    "default_start_by_gauge": default_start_by_gauge,
    "year_to_date_by_group": year_to_date_by_group,
    "unique_tags_by_group": unique_tags_by_group,
    "unique_tags_all_groups": unique_tags_all_groups,
    "length_bars_by_group": length_bars_by_group,
    "map_points_by_group": map_points_by_group,
    "default_start_by_group": default_start_by_group,
    "saved_individuals": saved_individuals,
    "saved_daily": saved_daily,
    "saved_locations": saved_locations,
    "saved_flow": saved_flow,
    "saved_series_window": saved_series_window,
    "season_overwrite": season_overwrite,
    "incremental_daily": incremental_daily,
    "incremental_detections": incremental_detections,
    "incremental_restated": incremental_restated,
    "incremental_late": incremental_late,
    "incremental_mixed_headers": incremental_mixed_headers,
    "reports_set_aside": reports_set_aside,
    "published_tables": published_tables,
    "cluster_pyramid": cluster_pyramid,
    "season_curves": season_curves,
    "gauge_compacted": gauge_compacted,
}
