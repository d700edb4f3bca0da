"""Lookup joins that hold up when the right side is large or one key is hot."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A right side is broadcast if its rows, counted, times the width of a row, as its types say, come to
# this many bytes at most.
BROADCAST_BYTES = 16 * 1024 * 1024
BROADCAST_ROWS = 200_000
# A string's or array's share in the width of a row, in bytes.
WIDE = 64

KeyPairs = list[tuple[str, str]]


def row_count(table: DataFrame) -> int:
    """Rows of a table; a Parquet scan answers this from file footers."""
    return table.count()


def unique_row_count(table: DataFrame, *key: str) -> int:
    """Rows of a dimension; a repeated key, which would multiply the rows joined, is an error."""
    rows, most = (
        table.groupBy(*key).count().agg(F.sum("count"), F.max("count")).first()
    )
    if most is not None and most > 1:
        raise ValueError(f"{', '.join(key)} is not unique")
    return rows or 0


def row_bytes(table: DataFrame) -> int:
    """About how many bytes a row takes, from the types of its columns."""
    return sum(
        WIDE if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))
        else 8 for f in table.schema.fields
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: KeyPairs,
    how: str = "left",
    max_broadcast_rows: int = BROADCAST_ROWS,
    right_rows: int | None = None,
    unique: bool = True,
) -> DataFrame:
    """Join on null-safe key pairs and drop the right key columns.

    The right side is broadcast if its rows, counted here unless given, are within the bounds of
    rows and bytes; beyond them the join is `split_join`.
    """
    if right_rows is None:
        right_rows = row_count(right)
    if right_rows <= max_broadcast_rows and right_rows * row_bytes(right) <= BROADCAST_BYTES:
        return _joined(left, F.broadcast(_with_key_names(right, on)), on, how)
    return split_join(left, right, on, how, unique)


def split_join(
    left: DataFrame, right: DataFrame, on: KeyPairs, how: str = "left", unique: bool = True
) -> DataFrame:
    """Join by one shuffle in which a hot key's rows are dealt over several tasks.

    A key is hot if it holds more than half of the rows that a shuffle task gets on average, so
    fewer keys than twice the tasks can be hot and their list, with the parts each is dealt into, is
    collected. The left rows of a hot key go to its parts by a hash of all their columns, so that a task that is
    run again deals them alike, and its right rows to every part.
    The left side is read once for its key columns and once for the join; without hot keys the join
    is a plain one. Right keys may repeat, whatever `unique` says.
    """
    right = _with_key_names(right, on)
    if how in ("left_semi", "left_anti"):
        right = right.select(_key_names(on)).distinct()
    hot = _hot_keys(left, on)
    if hot is None:
        return _joined(left, right, on, how)
    keys = [key for key, _ in on]
    dealt = _with_parts(left, keys, hot).withColumn(
        "_part", F.pmod(F.xxhash64(*left.columns), F.coalesce("_parts", F.lit(1)))
    ).drop("_parts")
    repeated = _with_parts(right, _key_names(on), hot).withColumn(
        "_right_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))
    ).drop("_parts")
    same = _all([
        *(F.col(key).eqNullSafe(F.col(name)) for key, name in zip(keys, _key_names(on))),
        F.col("_part") == F.col("_right_part"),
    ])
    return dealt.join(repeated, same, how).drop(*_key_names(on), "_part", "_right_part")


def _key_names(on: KeyPairs) -> list[str]:
    return [f"_right_key_{i}" for i in range(len(on))]


def _with_key_names(right: DataFrame, on: KeyPairs) -> DataFrame:
    right_keys = [r for _, r in on]
    return right.select(
        *[F.col(r).alias(name) for r, name in zip(right_keys, _key_names(on))],
        *[c for c in right.columns if c not in right_keys],
    )


def _joined(left: DataFrame, right: DataFrame, on: KeyPairs, how: str) -> DataFrame:
    condition = _all(
        F.col(key).eqNullSafe(F.col(name)) for (key, _), name in zip(on, _key_names(on))
    )
    return left.join(right, condition, how).drop(*_key_names(on))


def _hot_keys(left: DataFrame, on: KeyPairs) -> DataFrame | None:
    """The hot keys and their numbers of parts as a local table, so that plans do not repeat `left`."""
    keys = [key for key, _ in on]
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    share = F.col("_rows") * tasks / total
    # Small parts, since several of them meet in a task by chance.
    hot = counts.filter(share > 0.5).select(
        *[F.col(k).alias(f"_hot_key_{i}") for i, k in enumerate(keys)],
        F.ceil(8 * share).cast("long").alias("_parts"),
    ).toArrow()
    return left.sparkSession.createDataFrame(hot) if hot.num_rows else None


def _with_parts(table: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """The table with the number of parts of its row's key, null for keys that are not hot."""
    names = [c for c in hot.columns if c != "_parts"]
    condition = _all(F.col(key).eqNullSafe(F.col(name)) for key, name in zip(keys, names))
    return table.join(F.broadcast(hot), condition, "left").drop(*names)


def _all(conditions) -> Column:
    return reduce(and_, conditions)
