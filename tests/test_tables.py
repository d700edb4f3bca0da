"""Saved tables, gauge files and the batch job."""

import datetime as dt
import glob
import os
import tempfile
from dataclasses import replace

import golden as g
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reddwatch import schemas, session
from reddwatch.functions.times import within
from reddwatch.operators import detections as det
from reddwatch.params import SiteGroup, site_group_table
from reddwatch.plans.batch import Store, flow_table, run_batch, season_tables
from reddwatch.sources import gauges, published, tables
from reddwatch.streaming import ingest


def test_save_replaces_only_its_seasons(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.save_seasons(
        spark.createDataFrame([("a", 2024), ("b", 2025)], "x string, spawn_year int"), path
    )
    again = tables.save_seasons(
        spark.createDataFrame([("c", 2025)], "x string, spawn_year int"), path
    )
    assert g.rows_of(again) == [("a", 2024), ("c", 2025)]
    assert g.rows_of(tables.in_seasons(again, [2024])) == [("a", 2024)]
    assert tables.season_list(again) == [2024, 2025]


def test_season_without_rows_is_emptied(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = spark.createDataFrame([("a", 2024), ("b", 2025)], "x string, spawn_year int")
    tables.save_seasons(table, path)
    left = tables.save_seasons(table.filter("x = 'a'"), path, [2024, 2025])
    assert g.rows_of(left) == [("a", 2024)]
    assert tables.season_list(left) == [2024]


def test_empty_table_reads_back(spark, tmp_path):
    table = spark.createDataFrame([], "x string, spawn_year int")
    assert tables.save_seasons(table, f"{tmp_path}/t").count() == 0
    assert tables.save_table(table, f"{tmp_path}/u").count() == 0


@pytest.mark.parametrize("rebalance", [True, False])
def test_missing_season_is_kept_apart(spark, tmp_path, rebalance):
    table = spark.createDataFrame([("a", None), ("b", 2025)], "x string, spawn_year int")
    saved = tables.save_seasons(table, f"{tmp_path}/t", rebalance=rebalance)
    assert g.rows_of(saved) == [("a", None), ("b", 2025)]
    assert tables.season_list(saved) == [2025]


def test_gauge_files(spark, tmp_path):
    path = f"{tmp_path}/g"
    gauges.write_gauge(g.readings(spark), path)
    assert sorted(d for d in os.listdir(path) if d.startswith("year")) == [
        "year=2024", "year=2025",
    ]
    read = gauges.read_gauge(
        spark, path, ["G"], ["00060"], dt.date(2025, 1, 2), dt.date(2024, 12, 31)
    )
    assert g.rows_of(read, "date", "value") == [
        (dt.date(2024, 12, 31), 30.0), (dt.date(2025, 1, 1), 40.0), (dt.date(2025, 1, 2), 41.0),
    ]
    plan = g.plan_of(read)
    assert "PartitionFilters: [isnotnull(year" in plan
    for pushed in ("GreaterThanOrEqual(date,2024-12-31)", "EqualTo(parameter_cd,00060)"):
        assert pushed in plan


def test_landings_keep_what_is_stored(spark, tmp_path):
    path = f"{tmp_path}/g"
    day = [dt.date(2025, 1, i) for i in range(1, 4)]
    gauges.write_gauge(g.readings(spark, [
        ("G", day[0], "00060", 1.0), ("G", day[0], "00060", 2.0), ("G", day[1], "00060", 3.0)
    ]), path)
    gauges.write_gauge(g.readings(spark, [("H", day[2], "00060", 4.0)]), path)
    restated = g.readings(spark, [("G", day[1], "00060", 5.0)])
    for _ in range(2):  # a landing written again replaces itself
        gauges.write_gauge(restated, path, landing=2)
    read = gauges.read_gauge(spark, path, ["G", "H"], ["00060"], day[0], day[2])
    assert g.rows_of(read, "site_no", "date", "value") == [
        ("G", day[0], 1.0), ("G", day[0], 2.0), ("G", day[1], 5.0), ("H", day[2], 4.0),
    ]
    assert gauges.next_landing(spark, path) == 3
    assert gauges.read_gauge(spark, f"{tmp_path}/none", ["G"], ["00060"], *day[:2]).count() == 0


def test_folded_landings_read_as_before(spark, tmp_path):
    path = f"{tmp_path}/gauge"
    day = [dt.date(2025, 1, 1 + i) for i in range(3)]
    assert gauges.compact_gauge(spark, path) == [] and not tables.exists(spark, path)
    gauges.write_gauge(g.readings(spark, [("G", d, "00060", 1.0) for d in day] + [("G", dt.date(2024, 5, 5), "00060", 7.0)]), path)
    gauges.write_gauge(g.readings(spark, [("G", day[1], "00060", 2.0), ("G", day[1], "00060", 3.0)]), path)
    gauges.write_gauge(g.readings(spark, [("H", day[2], "00060", 4.0)]), path)

    def read():
        return g.rows_of(gauges.read_gauge(spark, path, ["G", "H"], ["00060"], dt.date(2024, 1, 1), day[2]))

    before = read()
    assert gauges.compact_gauge(spark, path, most=3) == [] and gauges.compact_gauge(spark, path) == [2025]
    assert read() == before
    stored = spark.read.parquet(path).filter("year = 2025")
    assert [r.landing for r in stored.select("landing").distinct().collect()] == [3]
    assert gauges.compact_gauge(spark, path, most=4) == [] and gauges.next_landing(spark, path) == 4
    gauges.write_gauge(g.readings(spark, [("G", day[0], "00060", 9.0)]), path)
    assert ("G", day[0], "00060", 9.0) in read() and len(read()) == len(before)


def test_wide_gauge_feed(spark):
    wide = spark.createDataFrame(
        [(dt.date(2025, 1, 1), 1.5, 40.0), (dt.date(2025, 1, 2), None, 41.0)],
        "Date date, X_00010_00003 double, X_00060_00003 double",
    )
    made = gauges.from_wide(wide, "G", {"X_00010_00003": "00010", "X_00060_00003": "00060"})
    assert g.rows_of(made) == sorted((r for r in g.READINGS if r[1].year == 2025), key=str)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("batch"))
    for i, row in enumerate(g.ROWS):
        g.write_report(f"{root}/in/{i}.csv", [row])
    g.write_report(f"{root}/down/d.csv", [[g.tag(3)]], header=["Tag"])
    store = Store(f"{root}/out")
    for _ in range(2):  # a second run replaces the first
        run_batch(
            spark, [f"{root}/in"], [f"{root}/down"], g.sites(spark), g.site_groups(spark),
            store, g.readings(spark), g.AS_OF,
        )
    return store


def test_batch_tables_hold_the_golden_season(spark, stored):
    single = season_tables(
        det.conform(g.report(spark)), g.downstream(spark), g.sites(spark), g.GROUP
    )
    for name in ("individuals", "daily", "locations"):
        expected = getattr(single, name)
        table = published.read(spark, stored.root, name)
        latest = table.filter("spawn_year = 2025 and site_group = 'G1'")
        assert g.rows_of(latest.select(expected.columns)) == g.rows_of(expected)


def test_batch_replaces_withdrawn_seasons_and_restatements(spark, tmp_path):
    """The same files give the same tables by batch and ingest, whatever was stored before."""
    store = Store(f"{tmp_path}/out")
    def run():
        run_batch(
            spark, [f"{tmp_path}/in"], [f"{tmp_path}/down"], g.sites(spark),
            g.site_groups(spark), store,
        )
        return published.read(spark, store.root, "individuals")
    g.write_report(f"{tmp_path}/down/d.csv", [[g.tag(3)]], header=["Tag"])
    g.write_report(f"{tmp_path}/in/a.csv", g.ROWS[9:10])
    assert g.rows_of(run(), "pit_id", "spawn_year") == [(g.tag(8), 2024)]
    os.remove(f"{tmp_path}/in/a.csv")
    first = [*g.ROWS[5][:7], "150"]
    restated = [*first[:3], "Adult", *first[4:7], "650"]
    for i, row in enumerate((first, restated)):
        g.write_report(f"{tmp_path}/in/{i}.csv", [row, [*g.ROWS[0][:6], "later", "1"]])
        os.utime(f"{tmp_path}/in/{i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    kept = run()
    assert g.rows_of(kept, "pit_id", "length_mm", "spawn_year") == [(g.tag(4), 650.0, 2025)]
    rejects = tables.read_table(spark, store.path("rejects")).first()
    assert (rejects.n_rows, rejects.bad_obs_time) == (4, 2)
    other = Store(f"{tmp_path}/ingested")
    ingest.ingest_reports(
        spark, f"{tmp_path}/in", other, g.site_groups(spark), g.downstream(spark, 3),
        g.sites(spark),
    )
    for name in ("individuals", "daily", "locations"):
        one, two = (published.read(spark, s.root, name) for s in (store, other))
        assert g.rows_of(one.select(sorted(one.columns))) == g.rows_of(two.select(sorted(two.columns)))


def test_detections_outside_every_group_are_counted_or_kept(spark, tmp_path):
    rows = [g.ROWS[0], [g.tag(30), *g.ROWS[0][1:5], "NEW - Array", *g.ROWS[0][6:]],
            [g.tag(31), *g.ROWS[0][1:5], "REL - Release only", *g.ROWS[0][6:]]]
    g.write_report(f"{tmp_path}/in/a.csv", rows)
    g.write_report(f"{tmp_path}/down/d.csv", [[g.tag(3)]], header=["Tag"])
    for everywhere, tags in ((False, 1), (True, 3)):
        group = replace(g.GROUP, home_release=("YANKFK", "REL"), all_sites=everywhere)
        store = Store(f"{tmp_path}/{everywhere}")
        run_batch(
            spark, [f"{tmp_path}/in"], [f"{tmp_path}/down"], g.sites(spark),
            site_group_table(spark, [group]), store,
        )
        single = season_tables(
            det.conform(g.report(spark, rows)), g.downstream(spark), g.sites(spark), group
        ).individuals
        table = published.read(spark, store.root, "individuals")
        assert g.rows_of(table.select(single.columns)) == g.rows_of(single)
        assert single.count() == tags
        like = spark.createDataFrame([], "observation_sitecode string, n long, spawn_year int")
        left_out = tables.read_table(spark, store.path("unmatched"), like)
        assert g.rows_of(left_out, "observation_sitecode", "n") == (
            [] if everywhere else [("NEW", 1), ("REL", 1)]
        )


def test_groups_of_listed_and_of_all_sites_together(spark):
    groups = [replace(g.GROUP, all_sites=True), SiteGroup("H", ("CEY", "YFK"), ("CEY",), (), ())]
    seen = spark.createDataFrame(
        [(s, "YANKFK") for s in ("YFK", "CEY", "NEW")], "observation_sitecode string, release_sitecode string"
    )
    flagged = det.flag_site_groups(seen, site_group_table(spark, groups))
    assert g.rows_of(
        flagged, "site_group", "observation_sitecode", "is_presence", "is_entry", "is_home_release"
    ) == [
        ("G1", "CEY", False, False, True), ("G1", "NEW", False, False, True), ("G1", "YFK", True, True, True),
        ("H", "CEY", True, False, False), ("H", "YFK", False, False, False),
    ]


def test_batch_tables_hold_earlier_seasons_too(spark, stored):
    older = published.read(spark, stored.root, "individuals").filter("spawn_year = 2024")
    assert g.rows_of(older, "pit_id", "length_mm") == [(g.tag(8), 700.0)]


def test_batch_flow(spark, stored):
    flow = published.read(spark, stored.root, "flow")
    assert flow.columns == [*schemas.FLOW_COLUMNS, "site_no"]
    assert flow.count() == 2


def test_batch_refuses_another_zone(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(ValueError, match="UTC"):
        run_batch(other, [], [], None, None, Store(str(tmp_path)))


@pytest.mark.parametrize("size, partitions", [
    (0, 200), (1, 200), (200 * session.SHUFFLE_TASK_BYTES + 1, 201), (10 * 2**40, 40_960),
])
def test_shuffle_partitions_grow_with_the_exchange(size, partitions):
    assert session.shuffle_partitions(size) == partitions


def test_flow_runs_to_today_by_default(spark):
    rows = [("G", dt.date(2025, 1, 1), "00060", 1.0), ("G", dt.date(2900, 1, 1), "00060", 2.0)]
    assert g.rows_of(flow_table(g.readings(spark, rows)), "date") == [(dt.date(2025, 1, 1),)]


def test_workspace_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    first, second = session.workspace(spark, "x"), session.workspace(spark, "x")
    assert first.startswith(f"{shared.rstrip('/')}/reddwatch/x-") and first != second


def test_workspace_needs_the_setting_on_a_cluster(spark):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.workspace(Session, "x")


def scanned_rows(frame):
    """Rows that the scan of a filter over files gives out, once it has run."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("whole_table", [False, True])
def test_a_window_of_one_group_reads_few_row_groups(spark, tmp_path, monkeypatch, whole_table):
    monkeypatch.setattr(tables, "ROW_GROUP_BYTES", 8192)
    rows = spark.range(40 * 2 * 300 * 4).select(
        F.format_string("group %02d", F.col("id") % 40).alias("site_group"),
        (F.col("id").cast("int") / 40 % 2 + 2024).cast("int").alias("spawn_year"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 80 % 300).cast("int")).alias("yfk_final_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    ).repartition(6)
    by = ["site_group", "yfk_final_date"]
    path = f"{tmp_path}/t"
    saved = tables.save_table(rows, path, by) if whole_table else tables.save_seasons(rows, path, cluster=by)
    assert saved.count() == rows.count() and not rows.exceptAll(saved.select(*rows.columns)).count()
    one, other = dt.date(2024, 3, 1), dt.date(2024, 3, 14)
    window = saved.filter(within("yfk_final_date", other, one)).filter("site_group = 'group 07'")
    wanted = window.count()
    assert wanted == 14 * 2 * 4
    groups = kept = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        data = pq.ParquetFile(file).metadata
        places = [data.schema.names.index(c) for c in by]
        for g in range(data.num_row_groups):
            group, date = (data.row_group(g).column(i).statistics for i in places)
            groups += 1
            kept += group.min <= "group 07" <= group.max and date.min <= other and date.max >= one
    assert groups >= 100 and kept <= 8
    # The reader skips the others: it gives out hardly more than the window of all 96,000 rows.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert wanted <= scanned_rows(window.select("note")) <= 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
