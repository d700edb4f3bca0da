"""Shape of the physical plans."""

import golden as g
import pytest

from reddwatch import schemas
from reddwatch.checks.queries import QUERIES
from reddwatch.operators import detections as det
from reddwatch.operators import lengths
from reddwatch.operators.daily import daily_entries
from reddwatch.operators.locations import cluster_pyramid
from reddwatch.operators.passage import cell_summary, individuals, tag_cells, tag_summary
from reddwatch.plans import serving
from reddwatch.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Golden detections as a saved table."""
    path = str(tmp_path_factory.mktemp("plans")) + "/detections"
    return tables.save_seasons(det.conform(g.report(spark)), path)


@pytest.mark.parametrize("name", [
    "individuals_by_group", "entry_daily_by_group", "locations_by_group", "gauge_sites_wide",
    "length_frequency_by_group", "detections_kept",
])
def test_no_python_and_no_nested_loops(spark, name):
    plan = g.plan_of(QUERIES[name](spark, SF))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_first_reduction_is_a_hash_aggregate_before_the_shuffle(stored):
    plan = g.plan_of(tag_summary(det.flag_sites(stored, g.GROUP)))
    assert plan.count("Exchange") - plan.count("AQEShuffleRead") >= 2
    first = plan[plan.index("(1) Scan"):]
    assert first.index("HashAggregate") < first.index("Exchange")
    assert "partial_min(observation_datetime" in plan
    assert "SinglePartition" not in plan


def test_latest_season_prunes_folders(stored):
    plan = g.plan_of(det.current_detections(stored))
    assert "PartitionFilters: [isnotnull(spawn_year" in plan
    assert "= Subquery" in plan[plan.index("PartitionFilters"):]


def test_latest_saved_season_prunes_folders(stored):
    plan = g.plan_of(serving.latest(stored))
    assert "= Subquery" in plan[plan.index("PartitionFilters"):]


def test_only_used_columns_are_read(stored):
    flagged = det.flag_sites(stored, g.GROUP)
    plan = g.plan_of(daily_entries(tag_summary(flagged)))
    scan = plan[plan.index("ReadSchema"):].splitlines()[0]
    for unused in ("length_mm", "rear_type", "yrs_at_large"):
        assert unused in schemas.DETECTIONS.fieldNames() and unused not in scan


def test_histogram_reads_individuals_once(spark):
    fish = spark.range(100).selectExpr(
        "'Adult' as release_lifestage", "cast(id * 9 as double) as length_mm"
    ).repartition(3)
    assert "ReusedExchange" in g.plan_of(lengths.length_frequency(fish), run=True)


def test_window_runs_per_season_after_the_daily_count(stored):
    plan = g.plan_of(daily_entries(tag_summary(det.flag_sites(stored, g.GROUP))))
    assert "SinglePartition" not in plan
    # The tree lists a parent before its children.
    assert plan.index("Window") < plan.index("HashAggregate")


def test_juvenile_rule_reads_the_reduced_tags_once(spark, stored):
    tags = tag_summary(det.flag_sites(stored, g.GROUP))
    plan = g.plan_of(individuals(tags, g.downstream(spark)))
    assert plan.count("Scan parquet") // 2 == 1 and "Union" not in plan


def test_gauge_series_takes_one_shuffle(spark):
    plan = g.plan_of(QUERIES["gauge_sites_wide"](spark, SF))
    assert plan.count("hashpartitioning") == 1


def test_date_window_reaches_the_scan(spark, tmp_path):
    flow = spark.sql(
        "select date'2025-01-01' as date, 1.0D as mean_temp, 2.0D as mean_discharge, 1 as group"
    )
    saved = tables.save_table(flow, f"{tmp_path}/flow")
    plan = g.plan_of(serving.discharge_series(saved, g.AS_OF, g.AS_OF))
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2025-04-18)" in plan
    scan = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "mean_temp" not in scan


def test_groups_meet_cells_and_not_detections(spark, stored):
    cells = tag_cells(stored.unionByName(stored).unionByName(stored))
    flagged = det.flag_site_groups(cells, g.site_groups(spark))
    plan = g.plan_of(cell_summary(flagged, ("site_group", "spawn_year")))
    # The tree lists a parent before its children: the join comes after the first aggregate.
    first_join = plan.index("BroadcastHashJoin")
    assert "partial_min(observation_datetime" in plan and plan.index("HashAggregate") > first_join
    met = flagged.count()
    assert met <= stored.select(
        "pit_id", "spawn_year", "release_sitecode", "release_lifestage", "release_datetime", "observation_sitecode"
    ).distinct().count()
    one = tag_summary(det.flag_site_groups(stored, g.site_groups(spark)), ("site_group", "spawn_year"))
    two = cell_summary(det.flag_site_groups(tag_cells(stored), g.site_groups(spark)), ("site_group", "spawn_year"))
    assert g.rows_of(one) == g.rows_of(two) and one.columns == two.columns


def test_pyramid_scans_its_rows_once(spark, stored):
    located = spark.range(50).selectExpr("'t' as pit_id", "1.0D as latitude", "2.0D as longitude").repartition(2)
    assert g.plan_of(cluster_pyramid(located)).count("Range (") <= 2
