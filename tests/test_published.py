"""The published state: one version of all tables, whatever is being written."""

import golden as g
import pytest

from reddwatch.sources import published
from reddwatch.sources.published import Run, State


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "tag string, spawn_year int")


def test_seasons_of_several_runs(spark, tmp_path):
    root = str(tmp_path)
    first = Run(spark, root)
    first.save("a", table(spark, ("x", 2023), ("y", 2024), ("z", 2025)))
    first.save("b", table(spark, ("x", 2023)))
    first.save_whole("flow", spark.createDataFrame([(1,)], "n int"))
    first.publish()
    second = Run(spark, root, [2024, 2025])
    assert g.rows_of(second.save("a", table(spark, ("w", 2025)))) == [("w", 2025)]
    second.publish()
    assert g.rows_of(published.read(spark, root, "a")) == [("w", 2025), ("x", 2023)]
    assert g.rows_of(published.read(spark, root, "b")) == [("x", 2023)]
    assert g.rows_of(published.read(spark, root, "flow")) == [(1,)]
    plan = g.plan_of(published.read(spark, root, "a").filter("spawn_year = 2025"))
    assert plan.count("PartitionFilters: [isnotnull(spawn_year") >= 1
    whole = Run(spark, root)
    whole.save("a", table(spark))
    whole.publish()
    assert published.read(spark, root, "a").columns == ["tag", "spawn_year"]
    assert published.read(spark, root, "a").count() == 0
    assert published.read(spark, root, "b").count() == 1


def test_a_run_that_breaks_off_and_a_reader_in_between(spark, tmp_path):
    root = str(tmp_path)
    one = Run(spark, root)
    for name in ("tags", "individuals", "daily", "locations"):
        one.save(name, table(spark, ("old", 2025)))
    one.publish()
    state = State.newest(spark, root)
    broken = Run(spark, root)
    broken.save("tags", table(spark, ("new", 2025)))
    broken.save("individuals", table(spark, ("new", 2025)))
    for name in ("tags", "individuals", "daily", "locations"):
        assert g.rows_of(published.read(spark, root, name)) == [("old", 2025)]
    two = Run(spark, root)
    for name in ("tags", "individuals", "daily", "locations"):
        two.save(name, table(spark, ("new", 2025)))
    two.publish()
    assert {g.rows_of(published.read(spark, root, n))[0][0] for n in ("tags", "daily")} == {"new"}
    assert g.rows_of(state.table("daily")) == [("old", 2025)]  # a state once resolved stays whole


def test_nothing_published(spark, tmp_path):
    assert not State.newest(spark, str(tmp_path)).has("a")
    with pytest.raises(ValueError, match="no table a"):
        published.read(spark, str(tmp_path), "a")


def test_of_two_writers_of_a_version_one_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    one, two = Run(spark, root), Run(spark, root)
    one.save("a", table(spark, ("x", 2025)))
    two.save("a", table(spark, ("y", 2025)))
    one.publish()
    monkeypatch.setattr(published, "_versions", lambda *_: None)  # as seen before the other one was there
    with pytest.raises(Exception, match="(?i)exists"):
        two.publish()
