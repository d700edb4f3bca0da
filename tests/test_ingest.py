"""Incremental ingest against the batch tables."""

import os

import golden as g
import pytest

from reddwatch.operators import detections as det
from reddwatch.plans.batch import Store, save_group_seasons
from reddwatch.sources import published, tables
from reddwatch.streaming import ingest

NAMES = ("individuals", "daily", "locations")


class Landing:
    """A landing folder whose files get increasing write times."""

    def __init__(self, folder):
        self.folder = str(folder)
        self.landed = 0

    def land(self, rows, **options):
        path = f"{self.folder}/{self.landed:03d}.csv"
        g.write_report(path, rows, **options)
        stamp = 1_700_000_000 + 60 * self.landed
        os.utime(path, (stamp, stamp))
        self.landed += 1


def take_in(spark, landing, store, seen=(3,), **options):
    ingest.ingest_reports(
        spark, landing.folder, store, g.site_groups(spark), g.downstream(spark, *seen),
        g.sites(spark), **options,
    )


def saved(spark, store):
    return {
        name: g.rows_of(published.read(spark, store.root, name).select(
            *sorted(published.read(spark, store.root, name).columns)
        ))
        for name in NAMES
    }


def batch(spark, rows, store):
    detections = det.conform(g.report(spark, rows))
    save_group_seasons(
        detections, g.site_groups(spark), g.downstream(spark), g.sites(spark), store,
        tables.season_list(detections),
    )
    return saved(spark, store)


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path / "landing")


@pytest.fixture
def store(tmp_path):
    return Store(f"{tmp_path}/store")


def test_files_one_at_a_time_equal_one_batch(spark, tmp_path, landing, store):
    expected = batch(spark, g.ROWS, Store(f"{tmp_path}/batch"))
    for part in (g.ROWS[:3], g.ROWS[3:9], g.ROWS[9:]):
        landing.land(part)
        take_in(spark, landing, store)
    assert saved(spark, store) == expected


def test_all_files_in_one_run_in_small_batches(spark, tmp_path, landing, store):
    expected = batch(spark, g.ROWS, Store(f"{tmp_path}/batch"))
    landing.land(g.ROWS[7:])
    landing.land(g.ROWS[:7])
    take_in(spark, landing, store, max_files_per_trigger=1)
    assert saved(spark, store) == expected


def test_repeated_report_changes_nothing(spark, landing, store):
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    before = saved(spark, store)
    logged = tables.read_table(spark, store.path("log")).count()
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    assert saved(spark, store) == before
    assert tables.read_table(spark, store.path("log")).count() == logged == 13


def test_restated_detection_takes_the_latest_file(spark, landing, store):
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    restated = [*g.ROWS[4][:7], "999"]
    landing.land([restated])
    take_in(spark, landing, store)
    individuals = published.read(spark, store.root, "individuals")
    assert individuals.filter(f"pit_id = '{g.tag(3)}'").first().length_mm == 999.0
    landing.land([g.ROWS[4]])
    take_in(spark, landing, store)
    individuals = published.read(spark, store.root, "individuals")
    assert individuals.filter(f"pit_id = '{g.tag(3)}'").first().length_mm == 150.0


def test_late_detection_moves_a_tag_and_later_totals(spark, tmp_path, landing, store):
    late = [*g.ROWS[10][:6], "04/20/2025 09:00:00 AM", "655"]
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    landing.land([late])
    take_in(spark, landing, store)
    assert saved(spark, store) == batch(spark, [*g.ROWS, late], Store(f"{tmp_path}/batch"))


def test_season_that_loses_its_last_tag_is_emptied(spark, landing, store):
    adult = [g.tag(20), "W", g.Y, "Adult", "05/01/2020", g.LOWER, "05/01/2023 06:00:00 AM", "5"]
    juvenile = [*adult[:3], "Juvenile", *adult[4:]]
    landing.land([adult])
    take_in(spark, landing, store)
    individuals = published.read(spark, store.root, "individuals")
    assert individuals.filter("spawn_year = 2023").count() == 1
    landing.land([juvenile])
    take_in(spark, landing, store)
    for name, rows in (("individuals", 0), ("daily", 0), ("locations", 1)):
        table = published.read(spark, store.root, name)
        assert table.filter("spawn_year = 2023").count() == rows


def test_replayed_batch_gives_the_same_log(spark, store):
    rows = det.conform(g.report(spark)).selectExpr(
        "*", "timestamp_seconds(1) as _source_time", "'f' as _source_file"
    )
    for _ in range(2):
        assert ingest.append_batch(rows, 0, store) == [2024, 2025]
    assert tables.read_table(spark, store.path("log")).count() == 13
    assert ingest.append_batch(rows, 1, store) == []


def test_rejects_are_counted_per_batch(spark, landing, store):
    landing.land([*g.ROWS, [*g.ROWS[0][:6], "later", "long"]])
    take_in(spark, landing, store)
    counts = tables.read_table(spark, store.path("rejects")).first()
    assert (counts.n_rows, counts.bad_obs_time, counts.bad_length) == (15, 1, 1)


def test_reports_of_other_shapes_are_taken_in_and_stray_files_set_aside(spark, tmp_path, landing, store):
    expected = batch(spark, g.ROWS, Store(f"{tmp_path}/batch"))
    landing.land(g.ROWS[:5])
    take_in(spark, landing, store)
    landing.land(g.ROWS[5:9], columns=list(reversed(g.HEADER)))
    landing.land([["x", "y"]] * 3, columns=["Other", "Thing"])
    landing.land(g.ROWS[9:], columns=["Extra", *g.HEADER, "Extra"])
    take_in(spark, landing, store)
    assert saved(spark, store) == expected
    aside = tables.read_table(spark, store.path("set_aside")).collect()
    assert [(r.file.split("/")[-1], r.header, r.n_lines) for r in aside] == [("002.csv", "Other,Thing", 4)]
    landing.land(g.ROWS[:1])
    take_in(spark, landing, store)
    assert saved(spark, store) == expected


def test_a_landing_of_stray_files_alone_leaves_no_rows(spark, landing, store):
    landing.land([["x"]], columns=["Other"])
    take_in(spark, landing, store)
    assert tables.read_table(spark, store.path("set_aside")).count() == 1
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    assert tables.read_table(spark, store.path("log")).count() == 13


def test_refresh_after_a_changed_downstream_report(spark, landing, store):
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    ingest.refresh_all(
        spark, store, g.site_groups(spark), g.downstream(spark, 3, 4), g.sites(spark)
    )
    individuals = published.read(spark, store.root, "individuals")
    assert individuals.filter(f"pit_id = '{g.tag(4)}'").count() == 1
    assert individuals.filter(f"pit_id = '{g.tag(5)}'").count() == 0


def test_replayed_and_broken_off_batches_end_in_the_same_state(spark, tmp_path, landing, store, monkeypatch):
    """A batch that stops between two tables leaves the old four; done again, it gives the new ones."""
    expected = batch(spark, g.ROWS, Store(f"{tmp_path}/batch"))
    landing.land(g.ROWS[:7])
    take_in(spark, landing, store)
    before = saved(spark, store)
    landing.land(g.ROWS[7:])
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "changed_entries", lambda *_: 1 / 0)
        with pytest.raises(Exception):
            take_in(spark, landing, store)
    assert tables.read_table(spark, store.path("log")).count() == 13
    assert saved(spark, store) == before
    take_in(spark, landing, store)
    assert saved(spark, store) == expected
    log = tables.read_table(spark, store.path("log"))
    last = log.agg({"ingest_batch": "max"}).first()[0]
    ingest.refresh(
        spark, store, g.site_groups(spark), g.downstream(spark), g.sites(spark), last, tables.season_list(log)
    )
    assert saved(spark, store) == expected


def test_daily_entries_come_from_touched_tags_and_stored_entries(spark, landing, store):
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    state = published.State.newest(spark, store.root)
    old = state.table("individuals").filter(f"pit_id = '{g.tag(3)}'")
    daily = state.table("daily")
    keys = ["site_group", "spawn_year"]
    plan = g.plan_of(ingest.changed_entries(daily, old, old.limit(0), keys))
    assert plan.count("Scan parquet") // 2 <= 3
    gone = ingest.changed_entries(daily, old, old.limit(0), keys)
    counted = lambda rows: sum(r.n for r in rows.collect())
    assert counted(gone) == counted(daily) - old.count() and gone.columns == daily.columns
    assert g.rows_of(ingest.changed_entries(gone, old.limit(0), old, keys)) == g.rows_of(daily)


def test_newest_per_key(spark):
    schema = ("pit_id string, observation_sitecode string, observation_datetime int, "
              "rear_type string, release_sitecode string, release_lifestage string, "
              "release_datetime int, length_mm double, ingest_batch long, "
              "_source_time int, _source_file string")
    rows = [
        ("a", "s", 1, "W", "x", "Adult", 1, 9.0, 0, 5, "f"),
        ("a", "s", 1, "W", "x", "Adult", 1, 1.0, 1, 4, "f"),
        ("a", "s", 1, "W", "x", "Adult", 1, 2.0, 1, 4, "g"),
        (None, "s", 1, "W", "x", "Adult", 1, None, 0, 1, "f"),
        (None, "s", 1, "W", "x", "Adult", 1, 3.0, 0, 1, "f"),
    ]
    newest = ingest.newest_per_key(spark.createDataFrame(rows, schema))
    assert g.rows_of(newest, "pit_id", "length_mm") == [("a", 2.0), (None, 3.0)]


def test_changed_downstream_report_alone_moves_its_tags(spark, landing, store):
    tables.save_table(g.downstream(spark, 3), store.path("downstream"))
    landing.land(g.ROWS)
    take_in(spark, landing, store)
    for seen, kept in (((3, 4), [3, 4]), ((4,), [4]), ((3,), [3])):
        ingest.refresh_downstream(spark, store, g.downstream(spark, *seen), g.sites(spark))
        individuals = published.read(spark, store.root, "individuals")
        juveniles = individuals.filter("release_lifestage = 'Juvenile' and spawn_year = 2025")
        assert g.rows_of(juveniles, "pit_id") == [(g.tag(n),) for n in kept]


def test_compacted_log_is_superseded_by_later_files(spark, landing, store):
    for part in (g.ROWS, [[*g.ROWS[4][:7], "999"]]):
        landing.land(part)
        take_in(spark, landing, store)
    before = g.rows_of(ingest.current_log(spark, store).drop("ingest_batch"))
    assert tables.read_table(spark, store.path("log")).count() == 14
    ingest.compact_log(spark, store)
    assert tables.read_table(spark, store.path("log")).count() == 13
    assert g.rows_of(ingest.current_log(spark, store).drop("ingest_batch")) == before
    landing.land([g.ROWS[4]])
    take_in(spark, landing, store)
    individuals = published.read(spark, store.root, "individuals")
    assert individuals.filter(f"pit_id = '{g.tag(3)}'").first().length_mm == 150.0


def test_only_rows_of_touched_tags_are_reduced(spark, store):
    rows = det.conform(g.report(spark)).selectExpr(
        "*", "timestamp_seconds(1) as _source_time", "'f' as _source_file"
    )
    ingest.append_batch(rows, 0, store)
    log = tables.read_table(spark, store.path("log"))
    touched = log.filter(f"pit_id = '{g.tag(1)}'").select("pit_id", "spawn_year")
    state = ingest.newest_per_key(ingest.touched_rows(log, touched))
    assert {r.pit_id for r in state.collect()} == {g.tag(1)}
    plan = g.plan_of(state)
    # The tree lists a parent before its children: rows are picked before they are reduced.
    assert plan.index("SortAggregate") < plan.index("LeftSemi")
