"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from reddwatch.params import ZONE


# A shuffle task should hold about this much; adaptive execution merges smaller ones.
SHUFFLE_TASK_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Shuffle partitions for the largest exchange of a job, never fewer than Spark's default."""
    return max(200, -(-shuffle_bytes // SHUFFLE_TASK_BYTES))


def build_session(
    app: str = "reddwatch", shuffle_bytes: int = 0, **extra: str
) -> SparkSession:
    """A session in the report's local zone, with adaptive execution on.

    `shuffle_bytes` is the expected size of the largest exchange. Further settings are given
    with `__` for each dot of their name.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffle_bytes)))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_zone(spark: SparkSession, zone: str = ZONE) -> None:
    """Report times are local wall-clock text, so the session must parse them in their zone."""
    current = spark.conf.get("spark.sql.session.timeZone")
    if current != zone:
        raise ValueError(f"session zone is {current}, reports are in {zone}")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, under the folder the cluster shares.

    Spark does not remove these folders: point `spark.checkpoint.dir` to a place that is cleared
    when jobs are done. A local session that leaves the setting out gets the machine's temporary
    folder; any other raises, since executors would each write to a folder of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/reddwatch/{purpose}-{uuid.uuid4().hex}"
