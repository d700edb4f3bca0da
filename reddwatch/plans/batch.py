"""The batch job: reports, sites and gauge readings to saved tables.

Per-tag rows, individuals, daily entries, locations and flow are published together (`sources.published`); what a run
reads or counts besides lies in folders of its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reddwatch import schemas
from reddwatch.operators.daily import daily_entries
from reddwatch.operators.detections import (
    conform,
    current_detections,
    drop_same_year_juveniles,
    flag_site_groups,
    flag_sites,
    newest_per_key,
    reject_columns,
    unmatched_sites,
)
from reddwatch.operators.exclusion import distinct_tags
from reddwatch.operators.gauges import daily_flow, flow_range
from reddwatch.operators.locations import locations
from reddwatch.operators.passage import (
    GROUP_SEASON,
    cell_summary,
    individuals,
    tag_cells,
    tag_summary,
)
from reddwatch.params import HOME_GROUP, SERIES_START, SiteGroup
from reddwatch.session import require_zone
from reddwatch.sources import tables
from reddwatch.sources.published import Run
from reddwatch.sources.reports import read_downstream, read_landed


# What tells the series of a flow table apart.
GAUGE = ("site_no",)
# What windows of the daily entries are read by.
ENTRY_WINDOW = ("site_group", "yfk_final_date")


@dataclass(frozen=True)
class Store:
    """Folders of one set of tables."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass(frozen=True)
class SeasonTables:
    """The tables derived from detections, not yet run."""

    individuals: DataFrame
    daily: DataFrame
    locations: DataFrame


def season_tables(
    detections: DataFrame,
    downstream: DataFrame,
    sites: DataFrame,
    group: SiteGroup = HOME_GROUP,
) -> SeasonTables:
    """Tables of the latest season for one site group."""
    tags = tag_summary(flag_sites(current_detections(detections), group))
    kept = individuals(tags, downstream)
    return SeasonTables(kept, daily_entries(kept), locations(tags, sites))


def flow_table(
    readings: DataFrame, as_of: dt.date | None = None, first: dt.date = SERIES_START,
    keys: Sequence[str] = (),
) -> DataFrame:
    """The daily series from `first` to `as_of` or today; `keys` of site_no tells gauges apart."""
    return flow_range(daily_flow(readings), first, as_of).select(*schemas.FLOW_COLUMNS, *keys)


def group_season_tags(detections: DataFrame, site_groups: DataFrame) -> DataFrame:
    """Per-tag rows of every site group and season.

    Detections are reduced to cells before they meet the groups, so it is cells that a site of several groups, or
    a group that takes all sites, multiplies.
    """
    usable = drop_same_year_juveniles(detections.filter(F.col("spawn_year").isNotNull()))
    return cell_summary(flag_site_groups(tag_cells(usable), site_groups), GROUP_SEASON)


def save_group_seasons(
    detections: DataFrame,
    site_groups: DataFrame,
    downstream: DataFrame,
    sites: DataFrame,
    store: Store,
    seasons: list[int],
    whole: bool = False,
    flow: DataFrame | None = None,
) -> None:
    """Save and publish the tables of every site group for the given seasons of `detections`.

    Each table is read back from its files by the next step, so the detections are scanned
    once and a lost executor costs only its own tasks. With `whole`, stored seasons other than
    these go. The flow table is published with the others if it is given.
    """
    run = Run(detections.sparkSession, store.root, None if whole else seasons)
    save_from_tags(
        run.save("tags", group_season_tags(tables.in_seasons(detections, seasons), site_groups)),
        downstream, sites, run,
    )
    if flow is not None:
        _save_flow(run, flow)
    run.publish()


def save_from_tags(tags: DataFrame, downstream: DataFrame, sites: DataFrame, run: Run) -> None:
    """Save the tables that follow from the per-tag rows of a run's seasons."""
    kept = run.save("individuals", individuals(tags, downstream, GROUP_SEASON))
    run.save("daily", daily_entries(kept, GROUP_SEASON), cluster=ENTRY_WINDOW)
    run.save("locations", locations(tags, sites, GROUP_SEASON))


def save_flow(flow: DataFrame, store: Store) -> None:
    """Save and publish the flow table alone."""
    run = Run(flow.sparkSession, store.root, [])
    _save_flow(run, flow)
    run.publish()


def _save_flow(run: Run, flow: DataFrame) -> None:
    run.save_whole("flow", flow, cluster=[c for c in (*GAUGE, "date") if c in flow.columns])


def run_batch(
    spark: SparkSession,
    report_paths: Iterable[str],
    downstream_paths: Iterable[str],
    sites: DataFrame,
    site_groups: DataFrame,
    store: Store,
    readings: DataFrame | None = None,
    as_of: dt.date | None = None,
    line_breaks: bool | str = True,
) -> None:
    """Reports to saved tables for all groups and seasons, and the flow series if given.

    The tables are those of these reports alone: what an earlier run stored and they do not hold
    goes. Of a detection that is restated the newest file counts, and files that are no reports are set
    aside, as in ingest.
    """
    require_zone(spark)
    report, aside = read_landed(spark, *report_paths, line_breaks=line_breaks)
    tables.save_table(aside, store.path("set_aside"))
    # CSV is parsed once, and what could not be read is counted as it passes by; every later step
    # reads the Parquet copy.
    rejects = Observation()
    observed = report.observe(rejects, *reject_columns())
    downstream = tables.save_table(
        distinct_tags(read_downstream(spark, *downstream_paths, line_breaks=line_breaks)),
        store.path("downstream"),
    )
    flow = None if readings is None else flow_table(readings, as_of, keys=GAUGE)
    save_detections(
        newest_per_key(conform(observed)), site_groups, downstream, sites, store, flow
    )
    tables.save_table(
        spark.createDataFrame([rejects.get], "n_rows long, bad_obs_time long, "
                              "bad_release_date long, bad_length long"),
        store.path("rejects"),
    )


def save_detections(
    detections: DataFrame,
    site_groups: DataFrame,
    downstream: DataFrame,
    sites: DataFrame,
    store: Store,
    flow: DataFrame | None = None,
) -> None:
    """Save detections and all that follows from them, in place of what is stored."""
    arrival = [c for c in detections.columns if c.startswith("_source")]
    saved = tables.save_seasons(
        detections.drop(*arrival), store.path("detections"), whole=True
    )
    tables.save_seasons(
        unmatched_sites(saved, site_groups), store.path("unmatched"), whole=True
    )
    save_group_seasons(
        saved, site_groups, downstream, sites, store, tables.season_list(saved), whole=True,
        flow=flow,
    )
