"""Exact top-k search by inner product with MaxScore.

A vector's components are terms, a query's terms those of its components that are not zero, and a posting's
score the product of the two. In each block of vectors a term's score is bounded by the block's largest and
least component. Terms are taken by the width of their bounds. Non-essential are the last ones, as many as cannot
reach the k-th best score found so far by themselves; the essential ones are scored for all vectors of the block. The
bounds of the others then tell which vectors can still reach that score, and only those are probed for the other
terms, a few at a time, as long as they stay competitive. The bar that a block has set holds for the next ones and
splits their terms; the first block, which has none, takes half of the bounds' width as essential. Shards of blocks are searched by tasks of their own and their best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reddwatch.llm.common import checked, partitions, picked, within_long, written

# Vectors of a block, and queries that travel together.
BLOCK, QUERIES = 4096, 256
# Terms probed between two looks at the bounds.
STRIDE = 8
# Blocks that a task holds on average.
HELD = 16
# Whole numbers below the first are exact as doubles, below the second as longs.
EXACT, LONG = 1 << 53, 1 << 62

BLOCKS = "block long, ids binary, data binary, size int"
FOUND = "query_id long, vec_id long, score long, wide boolean"


def stored(ids: np.ndarray, matrix: np.ndarray, number: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            pa.array([np.ascontiguousarray(matrix, dtype="<f8").tobytes()], pa.binary()),
            pa.array([matrix.shape[1]], pa.int32()),
        ],
        names=["block", "ids", "data", "size"],
    )


def loaded(ids: bytes, data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(data, "<f8").reshape(len(ids), size)


def blocked(vectors: DataFrame, block: int) -> DataFrame:
    """Rows vec_id, embedding as blocks of vectors of whole numbers, which doubles of any size hold exactly, without
    those that take no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids: list[int] = []
        rows: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            matrix = np.zeros((len(rows), max(map(len, rows), default=0)))
            for i, row in enumerate(rows):
                matrix[i, : len(row)] = row
            return stored(np.array(ids), matrix, number)

        for batch in batches:
            for vec_id, vector in zip(batch["vec_id"].to_pylist(), batch["embedding"].to_pylist()):
                if vec_id is None or vector is None or any(x is None for x in vector):
                    continue
                values = np.array(vector, dtype=np.float64)
                if not np.isfinite(values).all():
                    continue
                ids.append(vec_id)
                rows.append(np.floor(256 * values))
                if len(rows) == block:
                    yield out()
                    ids, rows, number = [], [], number + 1
        if rows:
            yield out()

    return vectors.mapInArrow(run, BLOCKS)


@dataclass
class Block:
    """Vectors as postings: one row of `terms` for each term, with its least and largest value."""

    ids: np.ndarray
    terms: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, matrix: np.ndarray) -> Block:
        return cls(ids, np.ascontiguousarray(matrix.T), matrix.min(axis=0, initial=0), matrix.max(axis=0, initial=0))

    def exact(self, query_id: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of all vectors in Python's numbers, for those that others do not hold."""
        numbers = [int(x) for x in query[: len(self.terms)].tolist()]
        kept = np.flatnonzero(self.ids != query_id)
        rows = self.terms[: len(numbers), kept].T.tolist()
        scores = [sum(a * int(b) for a, b in zip(numbers, row) if a and b) for row in rows]
        return self.ids[kept], np.array(scores, dtype=object)

    def best(self, query_id: int, query: np.ndarray, k: int, bar: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of what may be among the k best: all that reach both the k-th best score here and
        `bar`, a score that k vectors elsewhere are known to reach."""
        n = len(self.terms)
        top = int(max(np.abs(self.low).max(initial=0), self.high.max(initial=0)))
        reach = n * top * int(np.abs(query).max(initial=0))
        if reach >= LONG:
            return self.exact(query_id, query)
        kind = np.float64 if reach < EXACT else np.int64
        q = np.zeros(n, dtype=kind)
        q[: len(query)] = query[:n]
        low, high = self.low.astype(kind), self.high.astype(kind)
        most, least = np.maximum(q * low, q * high), np.minimum(q * low, q * high)
        order = np.argsort(least - most, kind="stable")
        order = order[q[order] != 0]
        rest_most = np.append(np.cumsum(most[order][::-1])[::-1], 0)
        rest_least = np.append(np.cumsum(least[order][::-1])[::-1], 0)
        if bar is None:
            width = rest_most - rest_least
            essential = int(np.searchsorted(-width, -width[0] / 2, side="right"))
        else:  # from there on the terms do not reach the bar by themselves
            essential = int(np.searchsorted(-rest_most, -min(bar, LONG), side="right"))
        alive = np.flatnonzero(self.ids != query_id)
        at = min(len(order), max(essential, STRIDE))
        part = (q[order[:at]] @ self.terms[order[:at]].astype(kind, copy=False))[alive]
        while True:
            if len(part) >= k:
                sure = int(np.partition(part, len(part) - k)[len(part) - k]) + int(rest_least[at])
                bar = sure if bar is None else max(bar, sure)
            if bar is not None:
                kept = part + rest_most[at] >= bar
                alive, part = alive[kept], part[kept]
            if at == len(order) or not len(alive):
                return self.ids[alive], part.astype(np.int64)
            terms = order[at : at + STRIDE]
            part = part + q[terms] @ self.terms[np.ix_(terms, alive)].astype(kind, copy=False)
            at += len(terms)


def best_of(blocks: list[Block], query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best over all blocks."""
    ids, scores, bar = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), None
    for block in blocks:
        more, found = block.best(query_id, query, k, bar)
        ids, scores = np.concatenate([ids, more]), np.concatenate([scores, found])
        if scores.dtype == object:
            top = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
        else:
            top = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[top], scores[top]
        if len(scores) == k:
            bar = int(scores[-1])
    return ids, scores


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = BLOCK, together: int = QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k vectors with the highest inner
    products, its own id left out, ties to the smaller id, all of them if there are fewer.

    Components are turned into floor(256 * x). A score among the results that does not fit a long stops the job. Rows with a null id, a null vector or a
    null or non-finite component take no part on either side. Of vectors of different length the missing
    components count as zero. Of queries that repeat an id the one with the largest vector is answered;
    vectors that repeat an id are candidates each. Empty tables give no rows; further columns are ignored.
    """
    columns = {"vec_id": (id_col, "long"), "embedding": (vector_col, "array<double>")}
    pool = written(blocked(picked(vectors, **columns), block), "maxscore-blocks")
    asked = picked(queries, **columns).dropna()
    asked = asked.filter("NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))")
    asked = asked.groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    questions = blocked(asked, together)
    # A shard's blocks are held by its task, all queries pass by in sets.
    shards = max(partitions(vectors.sparkSession), -(-pool.count() // HELD))
    rows = (
        pool.select(F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "ids", "data", "size")
        .union(questions.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), F.lit(1), "ids", "data", "size"))
    )
    rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[Block] = []
        for batch in batches:
            for row in batch.to_pylist():
                got = loaded(row["ids"], row["data"], row["size"])
                if row["kind"] == 0:
                    blocks.append(Block.of(*got))
                    continue
                found = [(i, *best_of(blocks, i, q, k)) for i, q in zip(got[0].tolist(), got[1])]
                fitted = [within_long(int(x)) for _, _, scores in found for x in scores.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(ids), i, dtype=np.int64) for i, ids, _ in found])),
                        pa.array(np.concatenate([ids for _, ids, _ in found])),
                        pa.array([x for x, _ in fitted], pa.int64()), pa.array([w for _, w in fitted], pa.bool_()),
                    ],
                    names=["query_id", "vec_id", "score", "wide"],
                )

    merged = rows.mapInArrow(run, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = merged.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", checked("score", "wide").alias("score"))
