"""Result sets of the cards: text, order, windows."""

import datetime as dt

import golden as g
import pytest
from pyspark.sql import functions as F

from reddwatch.operators import detections as det
from reddwatch.operators import lengths
from reddwatch.operators.daily import daily_entries, season_curves, side_by_side
from reddwatch.operators.locations import cluster_pyramid
from reddwatch.plans import serving
from reddwatch.plans.batch import flow_table, season_tables

WIDE = (dt.date(2024, 1, 1), dt.date(2026, 1, 1))


@pytest.fixture(scope="module")
def tables(spark):
    return season_tables(
        det.conform(g.report(spark)), g.downstream(spark), g.sites(spark), g.GROUP
    )


def test_flow_series(spark):
    flow = flow_table(g.readings(spark), g.AS_OF)
    discharge = serving.discharge_series(flow, *WIDE).collect()
    assert [tuple(r) for r in discharge] == [
        (dt.date(2025, 1, 1), 40.0, 1, " Date: 2025-01-01 <br> Mean Discharge (cfs):  40"),
        (dt.date(2025, 1, 2), 41.0, 1, " Date: 2025-01-02 <br> Mean Discharge (cfs):  41"),
    ]
    temperature = serving.temperature_series(flow, *WIDE).collect()
    assert [tuple(r) for r in temperature] == [
        (dt.date(2025, 1, 1), 1.5, 1, " Date: 2025-01-01 <br> Mean Temp (C):  1.5"),
        (dt.date(2025, 1, 2), None, 1, None),
    ]


def test_series_window_is_closed(spark):
    flow = flow_table(g.readings(spark), g.AS_OF)
    day = dt.date(2025, 1, 2)
    assert [r.date for r in serving.discharge_series(flow, day, day).collect()] == [day]


def test_year_to_date_and_entries(tables):
    curve = serving.year_to_date(tables.daily, *WIDE).collect()
    assert [r.text for r in curve] == [
        " Date: Oct 05 <br> Number In: 1",
        " Date: Mar 09 <br> Number In: 2",
        " Date: Apr 12 <br> Number In: 5",
    ]
    bars = serving.entries_by_day(tables.daily, *WIDE).collect()
    assert [(r.n, r.text) for r in bars] == [
        (1, " Date: 2024-10-05 <br> Number Steelhead Entered: 1"),
        (1, " Date: 2025-03-09 <br> Number Steelhead Entered: 1"),
        (3, " Date: 2025-04-12 <br> Number Steelhead Entered: 3"),
    ]


def test_length_card(tables):
    frequency = lengths.length_frequency(tables.individuals)
    assert [r.text for r in serving.length_bars(frequency).collect()] == [
        "Length Bin: 600<br>Number: 2", "Length Bin: 625<br>Number: 1",
        "Length Bin: 650<br>Number: 1",
    ]
    notes = serving.length_annotations(frequency).first()
    assert notes.n_label == "N = 4"
    assert notes.mean_label == "Mean Length = 629 mm"
    assert notes.mean_length == 629.25
    assert (notes.label_x, notes.n_label_y, notes.mean_label_y) == (
        pytest.approx(630.0), pytest.approx(1.76), pytest.approx(1.9),
    )
    assert notes.breaks == [600, 625, 650]
    assert g.rows_of(serving.length_axis_breaks(frequency)) == [(600,), (625,), (650,)]


@pytest.mark.parametrize("lengths_mm, label", [
    ([612.0, 613.0], "Mean Length = 612 mm"), ([613.0, 614.0], "Mean Length = 614 mm"),
])
def test_mean_label_rounds_half_to_even(spark, lengths_mm, label):
    fish = spark.createDataFrame(
        [("Adult", x) for x in lengths_mm], "release_lifestage string, length_mm double"
    )
    notes = serving.length_annotations(lengths.length_frequency(fish))
    assert notes.first().mean_label == label


def test_map_points(tables):
    points = serving.map_points(tables.locations).collect()
    assert len(points) == 8
    by_stage = {r.release_lifestage: r for r in points}
    assert by_stage["Adult"].popup == (
        "<b>Site Code: </b>LGRLDR<br><b>Site Name: </b>Lower Granite"
    )
    assert by_stage["Adult"].colour == "magenta"
    assert by_stage["Juvenile"].colour == "cyan"


def test_last_week_starts_at_local_midnight(spark):
    rows = [(dt.datetime(2025, 4, 10, 23, 59, 59),), (dt.datetime(2025, 4, 11),), (None,)]
    fish = spark.createDataFrame(rows, "yfk_entry_final timestamp")
    assert serving.new_in_last_week(fish, g.AS_OF).first()[0] == 1


def test_as_of_defaults_to_today(spark):
    now = spark.range(1).selectExpr("current_timestamp() as yfk_entry_final")
    assert serving.new_in_last_week(now).first()[0] == 1


def test_latest_season_of_a_saved_table(spark):
    table = spark.createDataFrame([(1, 2024), (2, 2025)], "n int, spawn_year int")
    assert g.rows_of(serving.latest(table)) == [(2, 2025)]


def test_each_level_of_the_pyramid_adds_up_to_the_ones_below(spark):
    places = [(-90.0, -180.0), (90.0, 180.0), (44.2, -114.7), (44.3, -114.8), (44.2, -114.7), (0.0, 0.0), (None, 3.0)]
    located = spark.createDataFrame([("t", *p) for p in places], "pit_id string, latitude double, longitude double")
    rows = cluster_pyramid(located, levels=10).collect()
    assert {r.level for r in rows} == set(range(10))
    cells = {(r.level, r.cell_x, r.cell_y): r for r in rows}
    assert len(cells) == len(rows) and cells[0, 0, 0].n_tags == 6
    for (level, x, y), r in cells.items():
        assert 0 <= x < 1 << level and 0 <= y < 1 << level
        below = [c for (lv, cx, cy), c in cells.items() if lv == level + 1 and (cx // 2, cy // 2) == (x, y)]
        if level < 9:
            assert sum(c.n_tags for c in below) == r.n_tags
            assert sum(c.n_tags * c.latitude for c in below) == pytest.approx(r.n_tags * r.latitude)


def test_curves_carry_totals_over_a_common_axis(spark):
    rows = [
        ("2023-07-01", 2, 2024), ("2024-02-29", 1, 2024), (None, 1, 2024), ("2025-02-28", 3, 2025), ("2025-06-30", 1, 2025),
    ]
    kept = spark.createDataFrame(
        [(d, y) for d, n, y in rows for _ in range(n)], "yfk_entry_final string, spawn_year int"
    ).withColumn("yfk_entry_final", F.to_timestamp("yfk_entry_final"))
    curves = season_curves(daily_entries(kept))
    by = {(r.spawn_year, r.season_day): r for r in curves.collect()}
    assert sum(y == 2024 for y, _ in by) == 366 and sum(y == 2025 for y, _ in by) == 365
    assert (2025, 244) not in by and str(by[2024, 244].date) == "2024-02-29"
    assert [by[2024, d].cumulative_total for d in (1, 2, 243, 244, 366)] == [2, 2, 2, 3, 3]
    assert [by[2025, d].cumulative_total for d in (1, 242, 243, 245, 365, 366)] == [0, 0, 3, 3, 3, 4]
    assert by[2024, 366].daily_cumulative == 0.75 and by[2025, 366].daily_cumulative == 1.0
    wide = side_by_side(curves, [2024, 2025]).collect()
    assert [r.season_day for r in wide] == list(range(1, 367))
    assert (wide[243]["2024"], wide[243]["2025"]) == (3, None)
    assert season_curves(daily_entries(kept.limit(0))).count() == 0
