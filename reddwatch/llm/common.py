"""What the operators share: column picking, scratch tables, number of partitions, packing of arrays."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reddwatch.session import workspace

# Sorts behind every other identifier; stands for a null one where order matters.
LAST_ID = np.iinfo(np.int64).max


def picked(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, as {new name: (old name, type)}; others can't clash with our own."""
    return df.select(*(F.col(f"`{old}`").cast(kind).alias(new) for new, (old, kind) in columns.items()))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text with null texts as empty ones."""
    return picked(df, doc_id=(id_col, "long"), text=(text_col, "string")).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: later steps read it, however many they are, and
    need nothing of what made it when an executor is lost."""
    spark = df.sparkSession
    folder = workspace(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


def null_last(column: Column) -> Column:
    return F.coalesce(column, F.lit(int(LAST_ID)))


def within_long(score: int) -> tuple[int, bool]:
    """A whole number as one that fits a long, and whether it had to be changed. Changed ones still sort beyond all others."""
    low, high = -(1 << 63), (1 << 63) - 1
    return min(max(score, low), high), not low <= score <= high


def checked(score: str, wide: str) -> Column:
    """The score of a result; one that did not fit a long stops the job."""
    return F.when(F.col(wide), F.raise_error(F.lit("a score among the results does not fit a long")).cast("long")).otherwise(
        F.col(score)
    )
