"""The golden dataset through the single-group plan: every expected table."""

import datetime as dt
import random

import golden as g
import pytest
from pyspark.sql import functions as F

from reddwatch.operators import detections as det
from reddwatch.operators import lengths
from reddwatch.operators.exclusion import exclude_tags, juveniles_not_downstream
from reddwatch.operators.locations import cluster_by_grid, cluster_by_site, with_coordinates
from reddwatch.operators.passage import (
    attach_release_info,
    individuals,
    release_info,
    tag_summary,
)
from reddwatch.plans import serving
from reddwatch.plans.batch import flow_table, season_tables


def at(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M")


EXPECTED_INDIVIDUALS = {
    1: ("2025-04-10 23:30", "2025-04-12 01:00", 1.0625, 610.0, "Adult", "LGRLDR"),
    2: ("2025-03-08 12:00", "2025-03-09 23:30", 1.4375, 640.0, "Adult", "LGRLDR"),
    3: ("2025-04-12 08:00", "2025-04-12 08:00", 0.0, 150.0, "Juvenile", "YANKFK"),
    7: (None, None, None, None, "Adult", "LGRLDR"),
    9: ("2024-10-05 17:45", "2024-10-05 17:45", 0.0, 655.0, "Adult", "LGRLDR"),
    11: ("2025-04-12 14:00", "2025-04-12 14:00", 0.0, 612.0, "Adult", "LGRLDR"),
    12: ("2025-04-15 03:00", None, None, 600.0, None, "XXUNK"),
}
EXPECTED_DAILY = [
    (dt.date(2024, 10, 5), 1, 7, 1),
    (dt.date(2025, 3, 9), 1, 7, 2),
    (dt.date(2025, 4, 12), 3, 7, 5),
    (None, 2, 7, 7),
]


@pytest.fixture(scope="module")
def detections(spark):
    return det.conform(g.report(spark))


@pytest.fixture(scope="module")
def tables(spark, detections):
    return season_tables(detections, g.downstream(spark), g.sites(spark), g.GROUP)


def test_detections(detections):
    current = det.current_detections(detections)
    rows = current.select("pit_id", "most_recent").collect()
    assert len(rows) == 11
    assert {r.pit_id for r in rows} == {g.tag(n) for n in (1, 2, 3, 4, 5, 7, 9, 11, 12)}
    assert {r.most_recent for r in rows} == {2025}


def test_exclusion_set_drops_every_juvenile_not_downstream(spark, detections):
    flagged = det.flag_sites(det.current_detections(detections), g.GROUP)
    excluded = juveniles_not_downstream(flagged, g.downstream(spark))
    assert g.rows_of(excluded) == [(g.tag(4),), (g.tag(5),)]
    kept = exclude_tags(flagged, excluded)
    assert kept.count() == 9
    assert kept.filter(F.col("pit_id").isin(g.tag(4), g.tag(5))).count() == 0


def test_exclusion_before_and_after_the_reduction_agree(spark, detections, tables):
    flagged = det.flag_sites(det.current_detections(detections), g.GROUP)
    excluded = juveniles_not_downstream(flagged, g.downstream(spark))
    early = individuals(tag_summary(exclude_tags(flagged, excluded)), g.downstream(spark))
    assert g.rows_of(early.select(tables.individuals.columns)) == g.rows_of(tables.individuals)


def test_individuals(tables):
    found = {r.pit_id: r for r in tables.individuals.collect()}
    assert set(found) == {g.tag(n) for n in EXPECTED_INDIVIDUALS}
    for number, expected in EXPECTED_INDIVIDUALS.items():
        row = found[g.tag(number)]
        first, final = (at(t) if t else None for t in expected[:2])
        assert (row.yfk_first, row.yfk_entry_final) == (first, final)
        assert (row.yfk_diff, row.length_mm) == expected[2:4]
        assert (row.release_lifestage, row.release_sitecode) == expected[4:]
    assert found[g.tag(11)].release_datetime is None
    assert found[g.tag(1)].release_datetime == dt.date(2024, 9, 15)


def test_release_join_gives_the_fused_columns(spark, detections, tables):
    flagged = det.flag_sites(det.current_detections(detections), g.GROUP)
    joined = attach_release_info(
        tables.individuals.drop("release_sitecode", "release_datetime"), release_info(flagged)
    )
    assert g.rows_of(joined.select(tables.individuals.columns)) == g.rows_of(tables.individuals)


def test_daily(tables):
    rows = tables.daily.orderBy("cumulative_total").collect()
    assert [
        (r.yfk_final_date, r.n, r.sy_total, r.cumulative_total) for r in rows
    ] == EXPECTED_DAILY
    for r in rows:
        assert r.daily_prop == r.n / 7
        assert r.daily_cumulative == r.cumulative_total / 7
        assert r.spawn_year == 2025


def test_locations_keep_excluded_juveniles(tables):
    found = {r.pit_id: r for r in tables.locations.collect()}
    assert len(found) == 9
    assert found[g.tag(4)].site_name == "Tributary"
    assert found[g.tag(12)].site_name is None
    assert found[g.tag(1)].latitude == 46.66


def test_clusters(tables):
    counts = {
        (r.release_sitecode, r.release_lifestage): r.n_tags
        for r in cluster_by_site(tables.locations).collect()
    }
    assert counts == {("LGRLDR", "Adult"): 5, ("YANKFK", "Juvenile"): 3, ("XXUNK", None): 1}
    assert with_coordinates(tables.locations).count() == 8
    cells = cluster_by_grid(tables.locations, 5.0)
    assert g.rows_of(cells) == [
        (40.0, -115.0, "Juvenile", 3), (45.0, -120.0, "Adult", 5),
    ]


def test_length_frequency(tables):
    expected = [(600.0, 2, 4, 629.25), (625.0, 1, 4, 629.25), (650.0, 1, 4, 629.25)]
    assert g.rows_of(lengths.length_frequency(tables.individuals)) == expected
    keyed = lengths.length_frequency(tables.individuals, ["spawn_year"])
    assert g.rows_of(keyed) == [(*row, 2025) for row in expected]


def test_flow(spark):
    assert g.rows_of(flow_table(g.readings(spark), g.AS_OF)) == [
        (dt.date(2025, 1, 1), 1.5, 40.0, 1), (dt.date(2025, 1, 2), None, 41.0, 1),
    ]


def test_scalars(tables):
    assert serving.unique_tags(tables.individuals).first()[0] == 7
    entered = serving.entered_since(tables.individuals, g.AS_OF)
    assert g.rows_of(entered, "pit_id") == [(g.tag(1),), (g.tag(3),), (g.tag(11),)]
    assert serving.new_in_last_week(tables.individuals, g.AS_OF).first()[0] == 3
    assert serving.default_start(tables.daily).first()[0] == dt.date(2024, 9, 21)


def test_window_keeps_totals_started_before_it(tables):
    shown = serving.year_to_date(tables.daily, dt.date(2025, 4, 30), dt.date(2025, 4, 1))
    rows = shown.collect()
    assert [(r.yfk_final_date, r.cumulative_total) for r in rows] == [(dt.date(2025, 4, 12), 5)]


def test_invariants(tables):
    total = tables.individuals.count()
    daily = tables.daily.agg(
        F.max("cumulative_total"), F.max("sy_total"), F.sum("daily_prop")
    ).first()
    assert daily[0] == daily[1] == total
    assert daily[2] == pytest.approx(1.0)
    frequency = lengths.length_frequency(tables.individuals)
    assert frequency.agg(F.sum("freq") == F.max("total_sample")).first()[0]
    assert tables.individuals.filter("yfk_diff < 0").count() == 0
    assert tables.locations.count() >= total
    assert tables.individuals.select("pit_id").distinct().count() == total


@pytest.mark.parametrize("seed", [1, 2])
def test_row_order_does_not_matter(spark, tables, seed):
    rows = list(g.ROWS)
    random.Random(seed).shuffle(rows)
    shuffled = det.conform(g.report(spark, rows).repartition(5))
    again = season_tables(shuffled, g.downstream(spark), g.sites(spark), g.GROUP)
    assert g.rows_of(again.individuals) == g.rows_of(tables.individuals)
    assert g.rows_of(again.daily) == g.rows_of(tables.daily)
    assert g.rows_of(again.locations) == g.rows_of(tables.locations)


def test_empty_downstream_excludes_the_third_juvenile(spark, detections):
    flagged = det.flag_sites(det.current_detections(detections), g.GROUP)
    excluded = juveniles_not_downstream(flagged, g.no_tags(spark))
    assert g.rows_of(excluded) == [(g.tag(n),) for n in (3, 4, 5)]


def test_empty_detections_give_empty_tables(spark):
    empty = det.conform(g.report(spark).limit(0))
    made = season_tables(empty, g.downstream(spark), g.sites(spark), g.GROUP)
    assert made.individuals.count() == made.daily.count() == made.locations.count() == 0
    assert lengths.length_frequency(made.individuals).count() == 0
    assert serving.unique_tags(made.individuals).first()[0] == 0


def test_repeated_site_code_is_rejected(spark, detections):
    doubled = g.sites(spark, [*g.SITES, ("LGRLDR", "Again", 1.0, 2.0)])
    with pytest.raises(ValueError, match="not unique"):
        season_tables(detections, g.downstream(spark), doubled, g.GROUP)


def test_group_table_and_group_parameters_agree(spark, detections):
    flagged = det.flag_site_groups(detections, g.site_groups(spark))
    literal = det.flag_sites(detections, g.GROUP).select(flagged.columns)
    assert g.rows_of(flagged) == g.rows_of(literal)
