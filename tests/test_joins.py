"""Lookup and split joins against a plain join worked out in Python."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import golden as g
from pyspark.sql import functions as F
from reddwatch.operators import joins


def reference(left, right, how):
    lookup = {}
    for key, value in right:
        lookup.setdefault(key, []).append(value)
    out = []
    for key, number in left:
        matches = lookup.get(key)
        if how == "left_semi" and matches or how == "left_anti" and not matches:
            out.append((key, number))
        elif how in ("left", "inner") and matches:
            out += [(key, number, value) for value in matches]
        elif how == "left":
            out.append((key, number, None))
    return sorted(out, key=str)


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, "k string, n int"),
        spark.createDataFrame(right, "code string, v int"),
    )


SKEWED = [("hot", i) for i in range(500)] + [(None, i) for i in range(300)] + [
    (f"k{i}", i) for i in range(700)
]
LOOKUP = [("hot", 1), (None, 2)] + [(f"k{i}", i) for i in range(0, 700, 2)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("bound", [0, 10_000])
def test_lookup_join_on_both_sides_of_the_bound(spark, how, bound):
    left, right = frames(spark, SKEWED, LOOKUP)
    joined = joins.lookup_join(left, right, [("k", "code")], how, max_broadcast_rows=bound)
    assert g.rows_of(joined) == reference(SKEWED, LOOKUP, how)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_with_repeated_right_keys(spark, how):
    repeated = [*LOOKUP, ("hot", 7), ("k2", 8)]
    left, right = frames(spark, SKEWED, repeated)
    joined = joins.split_join(left, right, [("k", "code")], how, unique=False)
    assert g.rows_of(joined) == reference(SKEWED, repeated, how)


def test_split_join_keeps_identical_rows(spark):
    copies = [("same", 1)] * 400 + [("other", 2)] * 3
    left, right = frames(spark, copies, [("same", 5)])
    joined = joins.split_join(left, right, [("k", "code")])
    assert g.rows_of(joined) == reference(copies, [("same", 5)], "left")


def test_fewer_keys_are_hot_than_the_share_allows(spark):
    left, _ = frames(spark, SKEWED, LOOKUP)
    hot = joins._hot_keys(left, [("k", "code")])
    assert {r[0] for r in hot.collect()} == {"hot", None}
    many = spark.range(10_000).selectExpr("cast(id as string) as k", "1 as n")
    assert joins._hot_keys(many, [("k", "code")]) is None


def test_no_task_gets_much_more_than_its_share(spark):
    """A key just under one row in two hundred, and one with a third of all rows."""
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "400")
    other.conf.set("spark.sql.adaptive.enabled", "false")
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = other.range(60_000).selectExpr(
        "CASE WHEN id < 20000 THEN 'third' WHEN id < 20290 THEN 'warm' ELSE concat('k', id) END AS k", "id AS n"
    )
    right = left.select("k").distinct().selectExpr("k AS code", "1 AS v")
    joined = joins.split_join(left, right, [("k", "code")])
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * 60_000 / 400 + 60


def test_chained_split_joins_stay_small(spark):
    left, right = frames(spark, SKEWED, LOOKUP)
    for i in range(4):
        left = joins.split_join(
            left, right.withColumnRenamed("v", f"v{i}"), [("k", "code")]
        )
    assert left.count() == len(SKEWED)
    assert g.plan_of(left).count("Union") <= 2 * (2**4 - 1)


def test_split_join_on_two_keys(spark):
    left = spark.createDataFrame(
        [("a", 1, 0), ("a", 2, 0), ("b", None, 0), (None, None, 0)], "x string, y int, z int"
    )
    right = spark.createDataFrame([("a", 1, 9), (None, None, 8)], "p string, q int, v int")
    joined = joins.split_join(left, right, [("x", "p"), ("y", "q")])
    assert g.rows_of(joined) == sorted(
        [("a", 1, 0, 9), ("a", 2, 0, None), ("b", None, 0, None), (None, None, 0, 8)], key=str
    )


def test_split_join_with_a_right_side_taken_from_the_left(spark):
    left, _ = frames(spark, SKEWED, LOOKUP)
    some = left.filter("k = 'hot' or k = 'k3'")
    kept = joins.split_join(left, some, [("k", "k")], "left_anti")
    assert kept.count() == len(SKEWED) - 501


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    left=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5)),
                  min_size=1, max_size=30),
    keys=st.sets(st.sampled_from(["a", "c", "d", None]), min_size=1),
    how=st.sampled_from(["left", "inner", "left_semi", "left_anti"]),
)
def test_split_join_property(spark, left, keys, how):
    right = [(key, i) for i, key in enumerate(sorted(keys, key=str))]
    joined = joins.split_join(*frames(spark, left, right), [("k", "code")], how)
    assert g.rows_of(joined) == reference(left, right, how)


def test_unique_row_count(spark):
    _, right = frames(spark, SKEWED, LOOKUP)
    assert joins.unique_row_count(right, "code") == len(LOOKUP)
    assert joins.unique_row_count(right.limit(0), "code") == 0
    with pytest.raises(ValueError, match="not unique"):
        joins.unique_row_count(right.union(right), "code")
