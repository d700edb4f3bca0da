"""Incremental ingest: new report files to an append-only log and refreshed season tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reddwatch import schemas
from reddwatch.operators.daily import changed_entries
from reddwatch.operators.detections import (
    conform,
    newest_per_key,
    reject_counts,
    unmatched_sites,
)
from reddwatch.operators.locations import locations
from reddwatch.operators.passage import GROUP_SEASON, individuals
from reddwatch.plans.batch import (
    ENTRY_WINDOW,
    Store,
    group_season_tags,
    save_from_tags,
    save_group_seasons,
)
from reddwatch.session import require_zone
from reddwatch.sources import tables
from reddwatch.sources.published import Run, State
from reddwatch.sources.reports import as_pattern, read_landed, stream_files

LOG_PARTITION = ["spawn_year", "ingest_batch"]


def with_keys_of(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows of the detections in a batch, so that a small batch reads little of a season."""
    keys = batch.select(*[F.col(c).alias(f"_batch_{c}") for c in schemas.DETECTION_KEY])
    same = F.lit(True)
    for column in schemas.DETECTION_KEY:
        same = same & F.col(column).eqNullSafe(F.col(f"_batch_{column}"))
    return stored.join(keys, same, "left_semi")


def changed_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of a batch that are new or differ from the stored state of their detection."""
    compared = [*schemas.DETECTION_KEY, *schemas.DETECTION_PAYLOAD]
    known = stored.select(*[F.col(c).alias(f"_known_{c}") for c in compared])
    same = F.lit(True)
    for column in compared:
        same = same & F.col(column).eqNullSafe(F.col(f"_known_{column}"))
    return batch.join(known, same, "left_anti")


def append_batch(detections: DataFrame, batch_id: int, store: Store) -> list[int]:
    """Add the new and changed detections of a batch to the log and return their seasons.

    Only earlier batches are compared, and the batch writes folders of its own, so a batch
    replayed after a failure gives the same log.
    """
    return append_arrived(detections, batch_id, store)[0]


def append_arrived(detections: DataFrame, batch_id: int, store: Store) -> tuple[list[int], DataFrame]:
    """`append_batch`, and all detections of the batch, whether they changed the log or not."""
    timed = detections.filter(F.col("spawn_year").isNotNull()).withColumn(
        "ingest_batch", F.lit(batch_id).cast("long")
    )
    newest = newest_per_key(timed)
    spark, path = detections.sparkSession, store.path("log")
    if not tables.exists(spark, path):  # the first batch is new as a whole
        seasons = sorted(tables.write_seasons(newest, path, LOG_PARTITION))
        return seasons, tables.read_table(spark, path, newest).filter(F.col("ingest_batch") == batch_id)
    arrived = tables.save_table(newest, store.path("arrived"))
    log = tables.read_table(spark, path, arrived)
    earlier = tables.in_seasons(
        log.filter(F.col("ingest_batch") < batch_id), tables.season_list(arrived)
    )
    fresh = changed_rows(arrived, newest_per_key(with_keys_of(earlier, arrived)))
    return sorted(tables.write_seasons(fresh, path, LOG_PARTITION)), arrived


def current_log(spark: SparkSession, store: Store) -> DataFrame:
    """The latest state of every logged detection."""
    return newest_per_key(tables.read_table(spark, store.path("log")))


def ingest(
    spark: SparkSession,
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    store: Store,
    site_groups: DataFrame,
    downstream: DataFrame,
    sites: DataFrame,
    count_rejects: bool = False,
    read: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> None:
    """Take in all files the stream has not seen yet, then stop.

    `prepare` turns staged stream rows into detections. With `read` the stream has names of files, of
    which it makes rows and the files to set aside. Only the tags that a batch touched are
    reduced again, from the log, and put in the place of their old rows in the tables (`refresh`), which
    are published together when all are written.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The stream's own session runs without adaptive execution, so it only stages rows.
        rows = batch
        if read is not None:
            rows, aside = read(batch)
            _save_by_batch(aside, batch_id, store.path("set_aside"))
        rows.write.mode("overwrite").parquet(store.path("staging"))
        staged = spark.read.schema(rows.schema).parquet(store.path("staging"))
        if count_rejects:
            _save_by_batch(reject_counts(staged), batch_id, store.path("rejects"))
        seasons, arrived = append_arrived(prepare(staged), batch_id, store)
        _save_by_batch(unmatched_sites(arrived, site_groups), batch_id, store.path("unmatched"))
        if seasons:
            refresh(spark, store, site_groups, downstream, sites, batch_id, seasons)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", store.path("progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_reports(
    spark: SparkSession,
    landing: str,
    store: Store,
    site_groups: DataFrame,
    downstream: DataFrame,
    sites: DataFrame,
    max_files_per_trigger: int | None = None,
    line_breaks: bool | str = True,
) -> None:
    """Take in newly landed detection reports, and set aside the files that are none."""
    require_zone(spark)
    ingest(
        spark, stream_files(spark, landing, max_files_per_trigger), conform, store, site_groups,
        downstream, sites, count_rejects=True, read=landed_reader(spark, line_breaks),
    )


def landed_reader(
    spark: SparkSession, line_breaks: bool | str = True
) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """What reads the reports that a batch of file names names."""

    def read(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        paths = [as_pattern(row.path) for row in batch.select("path").collect()]
        return read_landed(spark, *paths, line_breaks=line_breaks)

    return read


def touched_rows(log: DataFrame, touched: DataFrame) -> DataFrame:
    """Log rows of the touched tags, in the seasons they were touched in."""
    keys = touched.select(F.col("pit_id").alias("_tag"), F.col("spawn_year").alias("_season"))
    same = F.col("pit_id").eqNullSafe(F.col("_tag")) & (F.col("spawn_year") == F.col("_season"))
    return log.join(keys.distinct(), same, "left_semi")


def of_tags(rows: DataFrame, touched: DataFrame, how: str) -> DataFrame:
    """Rows of the touched tags in the seasons they were touched in, or with left_anti all others."""
    keys = touched.select(F.col("pit_id").alias("_tag"), F.col("spawn_year").alias("_season"))
    same = F.col("pit_id").eqNullSafe(F.col("_tag")) & (F.col("spawn_year") == F.col("_season"))
    return rows.join(keys, same, how)


def refresh(
    spark: SparkSession, store: Store, site_groups: DataFrame, downstream: DataFrame, sites: DataFrame,
    batch_id: int, seasons: list[int],
) -> None:
    """Put the tags that a batch touched, reduced anew, in the place of their old rows, and publish.

    Rows of other tags are copied as they are. Daily entries take back what the touched tags counted for
    and add what they count for now, so they come from these tags and the stored entries alone. The tables
    agree with each other in every published state, so a replayed batch gives the same from any of them.
    """
    run = Run(spark, store.root, seasons)
    log = tables.in_seasons(tables.read_table(spark, store.path("log")), seasons)
    touched = log.filter(F.col("ingest_batch") == batch_id).select("pit_id", "spawn_year").distinct()
    if not run.before.has("tags"):  # all tags of the log are new
        # A batch has each detection once.
        one_batch = log.filter(F.col("ingest_batch") != batch_id).isEmpty()
        state = log if one_batch else newest_per_key(log)
        tags = run.save("tags", group_season_tags(state, site_groups))
        save_from_tags(tags, downstream, sites, run)
        run.publish()
        return
    touched = run.keep("touched", touched)
    fresh = run.keep(
        "fresh", group_season_tags(newest_per_key(touched_rows(log, touched)), site_groups)
    )
    kept = run.keep("kept", individuals(fresh, downstream, GROUP_SEASON))

    def before(name: str) -> DataFrame:
        return tables.in_seasons(run.before.table(name), seasons)

    for name, new in (
        ("tags", fresh), ("individuals", kept), ("locations", locations(fresh, sites, GROUP_SEASON)),
    ):
        run.save(name, of_tags(before(name), touched, "left_anti").unionByName(new))
    old = of_tags(before("individuals"), touched, "left_semi")
    run.save("daily", changed_entries(before("daily"), old, kept, GROUP_SEASON), cluster=ENTRY_WINDOW)
    run.publish()


def refresh_downstream(
    spark: SparkSession, store: Store, downstream: DataFrame, sites: DataFrame
) -> DataFrame:
    """Store a downstream report and compute the seasons of tags that came or went anew.

    Gives the stored set. The per-tag rows are there already, so the log is not read. The seasons
    follow from the tags before the set is replaced, so a run that fails in between is repeated
    whole by the next one.
    """
    path = store.path("downstream")
    stored = downstream.limit(0)
    if tables.exists(spark, path):
        stored = tables.read_table(spark, path, downstream)
    fresh = tables.save_table(downstream, store.path("downstream_next"))
    changed = (
        fresh.withColumn("_new", F.lit(1)).unionByName(stored.withColumn("_new", F.lit(0)))
        .groupBy("pit_id").agg(F.min("_new").alias("low"), F.max("_new").alias("high"))
        .filter("low = high").select(F.col("pit_id").alias("_tag"))
    )
    state = State.newest(spark, store.root)
    if state.has("tags"):
        tags = state.table("tags")
        moved = tags.filter("home_juvenile").join(
            changed, F.col("pit_id").eqNullSafe(F.col("_tag")), "left_semi"
        )
        seasons = tables.season_list(moved)
        if seasons:
            run = Run(spark, store.root, seasons)
            save_from_tags(tables.in_seasons(tags, seasons), fresh, sites, run)
            run.publish()
    return tables.save_table(fresh, path)


def compact_log(spark: SparkSession, store: Store) -> None:
    """Rewrite the log as the newest state of each detection, one folder a season.

    All rows get the number of the last batch, so later ones still supersede them. Not to be run
    while a batch is taken in: the new log is written beside the old one and then takes its place.
    """
    log = tables.read_table(spark, store.path("log"))
    last = log.agg(F.max("ingest_batch")).scalar()
    newest = tables.save_seasons(
        newest_per_key(log).withColumn("ingest_batch", last), store.path("log_next"),
        partition=LOG_PARTITION, whole=True,
    )
    tables.save_seasons(newest, store.path("log"), partition=LOG_PARTITION, whole=True)


def refresh_all(
    spark: SparkSession,
    store: Store,
    site_groups: DataFrame,
    downstream: DataFrame,
    sites: DataFrame,
) -> None:
    """Compute every season anew, as a changed downstream report or site table calls for."""
    log = tables.read_table(spark, store.path("log"))
    seasons = tables.season_list(log)
    save_group_seasons(newest_per_key(log), site_groups, downstream, sites, store, seasons)


def _save_by_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    (
        rows.withColumn("ingest_batch", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_batch")
        .parquet(path)
    )
