"""Connected components of links between long numbers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex's larger neighbours are linked to the least of it and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a != b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex and its smaller neighbours are linked to the least of them; a > b on the way in."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .filter("a != b").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """vertex and root (the least vertex it is linked with, directly or not) for all linked vertices.

    `edges` has long columns a and b; repeated links, both directions and a = b may occur, rows with a
    null do not count. The number of rounds grows with the logarithm of the number of vertices squared;
    each is written to the shared folder, and a checksum of its links tells when nothing moves any more.
    """
    edges = written(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = None
    while True:
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
                edges.select(F.col("b"), F.col("b")).distinct()
            )
        seen = state
        edges = written(_small_star(_large_star(edges)), "links")
