"""Row rules, dates, numbers and text, one point each."""

import datetime as dt

import golden as g
import pytest
from pyspark.sql import functions as F

from reddwatch.functions import numeric, predicates, text, times
from reddwatch.operators import detections as det
from reddwatch.operators import lengths
from reddwatch.operators.passage import tag_summary


def value(spark, column, **columns):
    """One expression over a row of typed literals, given as (value, type)."""
    row = spark.range(1).select(
        *[F.lit(v).cast(kind).alias(name) for name, (v, kind) in columns.items()]
    )
    return row.select(column).first()[0]


@pytest.mark.parametrize("given, expected", [
    ("YFK - Lower array", "YFK"), ("YFK", "YFK"), (None, None), ("", ""), (" YFK", ""),
])
def test_first_word(spark, given, expected):
    assert value(spark, text.first_word("x"), x=(given, "string")) == expected


@pytest.mark.parametrize("given, expected", [
    ("04/10/2025 11:30:00 PM", dt.datetime(2025, 4, 10, 23, 30)),
    ("4/1/2025 1:05:09 AM", dt.datetime(2025, 4, 1, 1, 5, 9)),
    ("04/10/2025 12:00:00 AM", dt.datetime(2025, 4, 10)),
    ("04/10/2025 12:00:00 PM", dt.datetime(2025, 4, 10, 12)),
    ("2025-04-10 11:30", None), ("junk", None), (None, None),
])
def test_parse_obs_time(spark, given, expected):
    assert value(spark, times.parse_obs_time("x"), x=(given, "string")) == expected


def test_clock_changes(spark):
    def micros(given):
        return value(spark, F.unix_micros(times.parse_obs_time("x")), x=(given, "string"))

    hour = 3600 * 1_000_000
    assert micros("03/09/2025 02:30:00 AM") == micros("03/09/2025 03:30:00 AM")
    assert micros("11/02/2025 02:30:00 AM") - micros("11/02/2025 01:30:00 AM") == 2 * hour


def test_elapsed_days_counts_physical_time(spark):
    days = times.elapsed_days(times.parse_obs_time("a"), times.parse_obs_time("b"))
    spring = value(
        spark, days,
        a=("03/08/2025 12:00:00 PM", "string"), b=("03/10/2025 12:00:00 PM", "string"),
    )
    assert spring == pytest.approx(47 / 24)


def test_elapsed_days_without_a_zone(spark):
    days = times.elapsed_days("a", "b", zoned=False)
    plain = value(
        spark, days,
        a=("2025-03-08 12:00:00", "timestamp_ntz"),
        b=("2025-03-10 18:00:00.000001", "timestamp_ntz"),
    )
    assert plain == pytest.approx(2.25)


@pytest.mark.parametrize("given, expected", [
    ("09/15/2024", dt.date(2024, 9, 15)), ("9/5/2024", dt.date(2024, 9, 5)),
    ("13/45/2024", None), ("2024-09-15", None), (None, None),
])
def test_parse_month_day_year(spark, given, expected):
    assert value(spark, times.parse_month_day_year("x"), x=(given, "string")) == expected


@pytest.mark.parametrize("given, expected", [
    ("610", 610.0), ("610.5", 610.5), ("NaN", None), ("abc", None), (None, None),
])
def test_parse_number(spark, given, expected):
    assert value(spark, numeric.parse_number("x"), x=(given, "string")) == expected


@pytest.mark.parametrize("time, expected", [
    ("06/30/2025 11:59:59 PM", 2025), ("07/01/2025 12:00:00 AM", 2026), ("", None),
])
def test_spawn_year_edge(spark, time, expected):
    row = [g.tag(1), "W", g.L, "Adult", "09/15/2024", g.LOWER, time, "610"]
    assert det.conform(g.report(spark, [row])).first().spawn_year == expected


@pytest.mark.parametrize("years, stage, kept", [
    (0, "Juvenile", False), (0, None, False), (0, "Adult", True), (1, "Juvenile", True),
    (1, None, True), (None, "Adult", True), (None, "Juvenile", False), (None, None, False),
])
def test_same_year_juvenile_rule_with_missing_values(spark, years, stage, kept):
    row = spark.createDataFrame([(years, stage)], "yrs_at_large int, release_lifestage string")
    assert det.drop_same_year_juveniles(row).count() == int(kept)


def test_years_at_large_use_the_observation_year(spark):
    autumn = [g.tag(9), "W", g.L, "Adult", "09/20/2024", g.LOWER, "10/05/2024 05:45:00 PM", "1"]
    row = det.conform(g.report(spark, [autumn])).first()
    assert (row.spawn_year, row.yrs_at_large) == (2025, 0)


def test_latest_season_sees_rows_that_later_rules_drop(spark):
    rows = [
        [g.tag(1), "W", g.L, "Adult", "09/15/2023", g.LOWER, "04/10/2024 01:00:00 PM", "1"],
        [g.tag(2), "W", g.Y, "Juvenile", "04/01/2025", g.LOWER, "04/10/2025 01:00:00 PM", "1"],
    ]
    assert det.current_detections(det.conform(g.report(spark, rows))).count() == 0


@pytest.mark.parametrize("given, expected", [("A", True), ("Z", False), (None, False)])
def test_is_member(spark, given, expected):
    assert value(spark, predicates.is_member("x", ["A", "B"]), x=(given, "string")) is expected


@pytest.mark.parametrize("given, expected", [
    (599.99, 575.0), (600.0, 600.0), (0.0, 0.0), (-1.0, -25.0), (None, None),
])
def test_floor_bin(spark, given, expected):
    assert value(spark, numeric.floor_bin("x"), x=(given, "double")) == expected


@pytest.mark.parametrize("given, expected", [(612.5, 612.0), (613.5, 614.0), (629.25, 629.0)])
def test_round_half_even(spark, given, expected):
    assert value(spark, numeric.round_half_even("x"), x=(given, "double")) == expected


@pytest.mark.parametrize("given, expected", [
    (40.0, "40"), (41.5, "41.5"), (0.0, "0"), (100.0, "100"), (0.1 + 0.2, "0.3"),
    (-2.25, "-2.25"), (123456.0, "123456"), (0.001, "0.001"), (None, None),
])
def test_number_text(spark, given, expected):
    assert value(spark, text.number_text("x"), x=(given, "double")) == expected


def test_joined_is_missing_when_a_part_is(spark):
    both = text.joined("a", F.col("x"), "b", sep=" ")
    assert value(spark, both, x=("1", "string")) == "a 1 b"
    assert value(spark, both, x=(None, "string")) is None
    assert value(spark, text.joined("a", F.col("x")), x=("1", "string")) == "a1"


def test_month_day_and_colour(spark):
    assert value(spark, text.month_day("d"), d=("2025-03-09", "date")) == "Mar 09"
    shades = [
        value(spark, text.lifestage_colour("s"), s=(s, "string"))
        for s in ("Juvenile", "Adult", "Fry", None)
    ]
    assert shades == ["cyan", "magenta", "#808080", "#808080"]


def test_bin_edges(spark):
    edges = numeric.bin_edges(F.col("a"), F.col("b"))
    assert value(spark, edges, a=(600.0, "double"), b=(650.0, "double")) == [600, 625, 650]


def test_window_bounds_in_either_order(spark):
    lo, hi = dt.date(2025, 4, 1), dt.date(2025, 4, 30)
    for one, other in ((lo, hi), (hi, lo)):
        for day, inside in (("2025-04-01", True), ("2025-04-30", True), ("2025-05-01", False)):
            assert value(spark, times.within("d", one, other), d=(day, "date")) is inside


def test_earliest_attributes_win_and_ties_take_the_smaller(spark):
    rows = [
        [g.tag(1), "W", "B - x", "Juvenile", "01/01/2020", g.LOWER, "04/10/2025 01:00:00 PM", "1"],
        [g.tag(1), "W", "C - x", "Adult", "01/01/2019", g.LOWER, "04/09/2025 01:00:00 PM", "2"],
        [g.tag(1), "W", "A - x", "Adult", "01/01/2021", g.LOWER, "04/09/2025 01:00:00 PM", "6"],
    ]
    flagged = det.flag_sites(det.conform(g.report(spark, rows)), g.GROUP)
    row = tag_summary(flagged).first()
    assert (row.release_sitecode, row.release_lifestage) == ("A", "Adult")
    assert (row.length_sum, row.length_count) == (9.0, 3)


def test_entry_sites_are_fewer_than_presence_sites(spark):
    rows = [
        [g.tag(1), "W", g.L, "Adult", "01/01/2020", g.TRIB, "04/10/2025 01:00:00 PM", "1"],
        [g.tag(1), "W", g.L, "Adult", "01/01/2020", g.LOWER, "04/09/2025 01:00:00 PM", "1"],
        [g.tag(1), "W", g.L, "Adult", "01/01/2020", g.TRIB, "04/08/2025 01:00:00 PM", "1"],
        [g.tag(1), "W", g.L, "Adult", "01/01/2020", "CEY - s", "04/07/2025 01:00:00 PM", "1"],
    ]
    row = tag_summary(det.flag_sites(det.conform(g.report(spark, rows)), g.GROUP)).first()
    assert row.yfk_first == dt.datetime(2025, 4, 8, 13)
    assert row.yfk_entry_final == dt.datetime(2025, 4, 9, 13)
    assert row.first_seen == dt.datetime(2025, 4, 7, 13)


def test_histogram_leaves_out_juveniles_and_missing_lengths(spark):
    rows = [("Adult", 599.99), ("Adult", 600.0), ("Adult", 0.0), ("Adult", None),
            ("Juvenile", 600.0), (None, 600.0)]
    fish = spark.createDataFrame(rows, "release_lifestage string, length_mm double")
    found = g.rows_of(lengths.length_frequency(fish), "length_bin", "freq", "total_sample")
    assert found == [(0.0, 1, 3), (575.0, 1, 3), (600.0, 1, 3)]
