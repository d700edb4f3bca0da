"""Settings of a run: zone, site groups, gauge codes and display constants."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from reddwatch import schemas


# Stands in the site group table for every site that the group doesn't list.
ANY_SITE = "*"


@dataclass(frozen=True)
class SiteGroup:
    """Observation sites watched together, and the release sites that count as home.

    With `all_sites` the group's report is its own, and a detection at a site that is not listed
    belongs to the group too, without being at a presence or entry site.
    """

    name: str
    members: tuple[str, ...]
    presence: tuple[str, ...]
    entry: tuple[str, ...]
    home_release: tuple[str, ...]
    all_sites: bool = False

    @property
    def watched(self) -> tuple[str, ...]:
        """Listed observation sites; a site that is a release site only is none of them."""
        return tuple(dict.fromkeys((*self.members, *self.presence, *self.entry)))

    def rows(self) -> list[tuple[str, str, bool | None, bool | None, bool]]:
        """Rows of the site group table: watched sites, then release sites, whose presence and entry
        flags are NULL, then ANY_SITE if the group takes all sites."""
        return [
            *((self.name, code, code in self.presence, code in self.entry,
               code in self.home_release) for code in self.watched),
            *((self.name, code, None, None, True)
              for code in dict.fromkeys(self.home_release) if code not in self.watched),
            *([(self.name, ANY_SITE, False, False, False)] if self.all_sites else []),
        ]


def site_group_table(spark: SparkSession, groups: Iterable[SiteGroup]) -> DataFrame:
    """The groups as a table, one row per group and site.

    Arrow data becomes a local relation, so counting and joining it needs no Python tasks.
    """
    names = schemas.SITE_GROUPS.fieldNames()
    rows = [dict(zip(names, row)) for group in groups for row in group.rows()]
    types = pa.schema(
        [(n, pa.bool_() if n.startswith("is_") else pa.string()) for n in names]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, types), schemas.SITE_GROUPS)


# Fixed values.
ZONE = "America/Los_Angeles"
HOME_GROUP = SiteGroup(
    name="YFK",
    members=("YFK", "CEY", "YANKWF", "YANKFK", "EIGH3C"),
    presence=("YFK", "YANKFK"),
    entry=("YFK",),
    home_release=("YANKFK",),
    all_sites=True,
)
GAUGE_SITE = "13296000"
TEMPERATURE = "00010"
DISCHARGE = "00060"
GAUGE_HISTORY_START = dt.date(1990, 1, 1)
SERIES_START = dt.date(2025, 1, 1)
SPAWN_YEAR_LAST_MONTH = 6
BIN_WIDTH = 25
TAG_PATTERN = r"^3DD\.[0-9A-F]{10}$"
LIFESTAGE_COLOURS = {"Juvenile": "cyan", "Adult": "magenta"}
OTHER_COLOUR = "#808080"
DISCHARGE_CAPTION = "Mean Discharge (cfs): "
TEMPERATURE_CAPTION = "Mean Temp (C): "
TOTAL_CAPTION = "Number In:"
ENTERED_CAPTION = "Number Steelhead Entered:"
LABEL_X, N_LABEL_Y, MEAN_LABEL_Y = 1.05, 0.88, 0.95
GAUGE_FEED_COLUMNS = {"X_00010_00003": TEMPERATURE, "X_00060_00003": DISCHARGE}
