"""Saved Parquet tables, partitioned by season."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SEASON = "spawn_year"
# Row groups of clustered files are small, so that a window of dates reads few bytes beside its own.
ROW_GROUP_BYTES = 8 * 1024 * 1024


def save_seasons(
    table: DataFrame,
    path: str,
    seasons: Iterable[int] = (),
    partition: Sequence[str] = (SEASON,),
    rebalance: bool = True,
    whole: bool = False,
    cluster: Sequence[str] = (),
) -> DataFrame:
    """Replace the seasons a table holds, leave other stored seasons, and read the result back.

    `cluster` names the columns by which windows are read; see `clustered`. With `whole`, the table is replaced as such: stored seasons that it does not hold go.

    `seasons` names those the table was computed for: one that came out without rows is emptied,
    which a dynamic overwrite alone would not do.
    """
    written = write_seasons(table, path, partition, rebalance, whole, cluster)
    # Spawn years are calendar years, so both lists are short.
    if not whole:
        for season in sorted(set(seasons) - written):
            _clear_season(table, path, season)
    return read_table(table.sparkSession, path, table)


def write_seasons(
    table: DataFrame, path: str, partition: Sequence[str] = (SEASON,), rebalance: bool = True, whole: bool = False,
    cluster: Sequence[str] = (),
) -> set[int]:
    """Replace the seasons a table holds, or with `whole` the stored table, and give those seasons.

    Rebalancing gathers a season into few files and splits one too large for a task; without it every task
    writes the seasons it holds. With `cluster`, each season's files hold ranges of those columns instead.
    """
    written = Observation()
    spread = table.hint("rebalance", *partition) if rebalance else table
    if cluster:
        spread = clustered(table, *partition, *cluster)
    (
        spread.observe(written, F.collect_set(SEASON).alias("seasons"))
        .write.mode("overwrite").options(**_layout(cluster))
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )
    return set(written.get["seasons"])


def clustered(table: DataFrame, *columns: str) -> DataFrame:
    """The rows in ranges of some columns, sorted by them within each range.

    Files written from it hold one range each, and their row groups and pages parts of it, so the least and largest
    values that Parquet keeps of them let a filter on the leading columns skip all others. Range borders come from
    a sample of the rows; adaptive execution puts small ranges together, a table of few rows into one file.
    """
    return table.repartitionByRange(*columns).sortWithinPartitions(*columns)


def _layout(cluster: Sequence[str]) -> dict[str, object]:
    return {"parquet.block.size": ROW_GROUP_BYTES} if cluster else {}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something was saved there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _clear_season(table: DataFrame, path: str, season: int) -> None:
    empty = table.sparkSession.createDataFrame([], table.drop(SEASON).schema)
    empty.write.mode("overwrite").parquet(f"{path}/{SEASON}={season}")


def save_table(table: DataFrame, path: str, cluster: Sequence[str] = ()) -> DataFrame:
    """Overwrite an unpartitioned table and read it back; `cluster` names the columns by which windows are read."""
    spread = clustered(table, *cluster) if cluster else table
    spread.write.mode("overwrite").options(**_layout(cluster)).parquet(path)
    return read_table(table.sparkSession, path, table)


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """A saved table; the schema of `like` lets a table without files be read as empty."""
    reader = spark.read if like is None else spark.read.schema(like.schema)
    stored = reader.parquet(path)
    return stored if like is None else stored.select(*like.columns)


def in_seasons(table: DataFrame, seasons: Iterable[int]) -> DataFrame:
    """Selected seasons; on a saved table the filter prunes folders."""
    return table.filter(F.col(SEASON).isin(list(seasons)))


def season_list(table: DataFrame) -> list[int]:
    """Spawn years present; calendar years, so a short list whatever the table's size."""
    rows = table.select(SEASON).filter(F.col(SEASON).isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)
