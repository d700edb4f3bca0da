"""Hard negatives by inner product, found with cover trees over norm-augmented vectors.

A block's vectors get one more component that brings them all to the length of the longest. On that sphere a
large inner product is a small angle, and a cover tree bounds it: a node's members lie within its covering
radius around its centre, and radii shrink by BASE from level to level. The angles between a query and a centre,
plus and minus that of the radius, bound the inner products of all members from both sides.

A search goes down from the best upper bounds, leaves out nodes that cannot beat what is found or lie outside all of
the query's windows of scores, and scores leaves with whole numbers. Blocks and their trees are rows of a
table; tasks hold some trees each, and the anchors pass by in sets: once for their positives, and once
more for the negatives in the windows that the positives' scores set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reddwatch.llm.common import (
    LAST_ID, checked, null_last, pack, partitions, picked, squeeze, unsqueeze, within_long, written,
)

# Between the covering radii of two levels.
BASE = 1.3
# Bytes of a block's vectors as 8-byte numbers, trees that a task holds on average, anchors of a set.
BLOCK, TREES, SET = 2 << 20, 16, 256
# Nodes opened at once; twice as many each time.
OPENED = 64
# What rounding can do to bounds, as a share of the largest inner product.
SLACK = 1e-7
# Whole numbers that doubles, and 8-byte numbers, hold exactly.
EXACT, LONG = 1 << 53, 1 << 63

BLOCKS = "number long, size int, ids binary, labels binary, data binary, wide boolean"
TREES_SCHEMA = BLOCKS + ", tree binary"


def whole(values: np.ndarray) -> np.ndarray:
    """floor(256 * x) of doubles as 8-byte numbers, or as Python's where those are too small."""
    if np.abs(values).max(initial=0) < 2.0**53:
        return np.floor(256.0 * values).astype(np.int64)
    numbers = [math.floor(256.0 * x) if abs(x) < 2.0**53 else 256 * int(x) for x in values.ravel().tolist()]
    return np.array(numbers, dtype=object).reshape(values.shape)


def stored(number: int, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> list[pa.Array]:
    wide = matrix.dtype == object
    data = ",".join(map(str, matrix.ravel().tolist())).encode() if wide else pack(matrix.astype("<i8"))
    return [
        pa.array([number], pa.int64()), pa.array([matrix.shape[1]], pa.int32()), pa.array([pack(ids)], pa.binary()),
        pa.array([pack(labels)], pa.binary()), pa.array([squeeze(data)], pa.binary()), pa.array([wide]),
    ]


def loaded(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and whole vectors of a stored block."""
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    data = unsqueeze(row["data"])
    if row["wide"]:
        flat = np.array([int(x) for x in data.decode().split(",")], dtype=object)
    else:
        flat = np.frombuffer(data, "<i8")
    return ids, labels, flat.reshape(len(ids), row["size"])


class CoverTree:
    """Nodes from above, children of a node side by side; members in an order in which each node's are side by
    side and its centre comes first."""

    def __init__(self, begin: np.ndarray, end: np.ndarray, radius: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.begin, self.end, self.radius, self.first, self.last = begin, end, radius, first, last

    def __len__(self) -> int:
        return len(self.begin)

    def packed(self) -> bytes:
        head = np.array([len(self)], dtype="<i8")
        numbers = np.concatenate([self.begin, self.end, self.first, self.last]).astype("<i4")
        return squeeze(pack(head) + pack(self.radius) + pack(numbers))

    @classmethod
    def unpacked(cls, data: bytes) -> CoverTree:
        data = unsqueeze(data)
        n = int(np.frombuffer(data, "<i8", 1)[0])
        radius = np.frombuffer(data, np.float64, n, 8)
        begin, end, first, last = np.frombuffer(data, "<i4", 4 * n, 8 + 8 * n).reshape(4, n).astype(np.int64)
        return cls(begin, end, radius, first, last)


def augmented(matrix: np.ndarray) -> tuple[np.ndarray, float]:
    """Vectors with one more component that makes all as long as the longest, and that length."""
    values = matrix.astype(np.float64)
    squares = (values * values).sum(axis=1)
    most = squares.max(initial=0.0)
    return np.column_stack([values, np.sqrt(np.maximum(most - squares, 0.0))]), math.sqrt(most)


def covered(points: np.ndarray, length: float) -> tuple[np.ndarray, CoverTree]:
    """The order of the members and the tree over points on a sphere of that radius."""
    tiny = SLACK * length

    def distances(some: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2.0 * length * length - 2.0 * (some @ centre), 0.0))

    order = np.arange(len(points))
    away = distances(points, points[0])
    top = float(away.max())
    begin, end, radius, first, last = [0], [len(points)], [top + tiny], [0], [0]
    waiting = [(0, away)]
    for node, away in waiting:  # grows while it is read: level by level
        a, b, most = begin[node], end[node], float(away.max())
        if b - a == 1 or most <= tiny:
            continue
        level = math.floor(math.log(top / most, BASE)) + 1 if most < top else 1
        reach = top * BASE**-level
        if reach >= most:
            reach = most / BASE
        rest, near = order[a:b], away <= reach
        near[0] = True
        groups = [(rest[near], away[near])]
        rest = rest[~near]
        some = points[rest]
        while len(rest):
            away = distances(some, some[0])
            near = away <= max(reach, tiny)
            near[0] = True
            groups.append((rest[near], away[near]))
            if near.sum() == 1:
                rest, some = rest[1:], some[1:]
            else:
                rest, some = rest[~near], some[~near]
        order[a:b] = np.concatenate([g for g, _ in groups])
        first[node] = len(begin)
        for group, away in groups:
            waiting.append((len(begin), away))
            begin.append(a)
            a += len(group)
            end.append(a)
            radius.append(float(away.max()) + tiny)
            first.append(0)
            last.append(0)
        last[node] = len(begin)
    arrays = (np.array(x) for x in (begin, end, radius, first, last))
    return order, CoverTree(*arrays)


def spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each begin up to before its end."""
    n = end - begin
    return np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)


class Windows:
    """The best k scores found in each window of scores, ties to the smaller id."""

    def __init__(self, low: list, high: list, k: int):
        self.low, self.high, self.k = low, high, k
        self.best: list[list[tuple]] = [[] for _ in low]  # score, id

    def floor(self, w: int):
        """What a score must reach to count in a window."""
        best = self.best[w]
        return max(self.low[w], best[-1][0]) if len(best) == self.k else self.low[w]

    def open_to(self, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Which of these ranges of scores could still change a window."""
        alive = np.zeros(len(upper), dtype=bool)
        for w in range(len(self.low)):
            alive |= (upper >= self.floor(w)) & (lower <= self.high[w])
        return alive

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w in range(len(self.low)):
            fits = np.flatnonzero((scores >= self.floor(w)) & (scores <= self.high[w]))
            if not len(fits):
                continue
            if len(fits) > self.k and scores.dtype != object:
                bar = np.partition(scores[fits], len(fits) - self.k)[len(fits) - self.k]
                fits = fits[scores[fits] >= bar]
            more = [(int(s), int(i)) for s, i in zip(scores[fits].tolist(), ids[fits].tolist())]
            self.best[w] = sorted(self.best[w] + more, key=lambda x: (-x[0], x[1]))[: self.k]


class Index:
    """A block's vectors under their cover tree."""

    def __init__(self, row: dict):
        self.ids, self.labels, self.rows = loaded(row)
        self.tree = CoverTree.unpacked(row["tree"])
        self.values = self.rows.astype(np.float64)
        squares = (self.values * self.values).sum(axis=1)
        self.length = math.sqrt(squares.max(initial=0.0))
        self.most = max((abs(int(x)) for x in (self.rows.max(initial=0), self.rows.min(initial=0))), default=0)

    def scored(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products of some members."""
        most = self.most * max((abs(int(x)) for x in query.tolist()), default=0) * max(1, len(query))
        if most < EXACT:
            return self.values[at] @ query.astype(np.float64)
        if most < LONG:
            return self.rows[at].astype(np.int64) @ query.astype(np.int64)
        return np.array([sum(a * b for a, b in zip(r, query.tolist())) for r in self.rows[at].tolist()], dtype=object)

    def bounds(self, nodes: np.ndarray, query: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
        """The greatest and the least inner product that members of these nodes can have."""
        scale = size * self.length
        if scale == 0.0:
            return np.zeros(len(nodes)), np.zeros(len(nodes))
        angle = np.arccos(np.clip(self.values[self.tree.begin[nodes]] @ query / scale, -1.0, 1.0))
        wide = 2.0 * np.arcsin(np.minimum(self.tree.radius[nodes] / (2.0 * self.length), 1.0))
        slack = SLACK * scale
        return (
            scale * np.cos(np.maximum(angle - wide, 0.0)) + slack,
            scale * np.cos(np.minimum(angle + wide, math.pi)) - slack,
        )

    def search(self, query: np.ndarray, takes: np.ndarray, windows: Windows) -> None:
        """Puts the best members among `takes` into the windows."""
        values = query.astype(np.float64)
        size = math.sqrt(float(values @ values))
        nodes = np.zeros(1, dtype=np.int64)
        upper, lower = self.bounds(nodes, values, size)
        opened = OPENED
        while len(nodes):
            alive = windows.open_to(upper, lower)
            nodes, upper, lower = nodes[alive], upper[alive], lower[alive]
            if len(nodes) > opened:
                order = np.argpartition(-upper, opened)
                best, rest = order[:opened], order[opened:]
            else:
                best, rest = np.arange(len(nodes)), np.zeros(0, dtype=np.int64)
            now = nodes[best]
            leaf = self.tree.last[now] == 0
            at = spans(self.tree.begin[now[leaf]], self.tree.end[now[leaf]])
            at = at[takes[at]]
            if len(at):
                windows.add(self.scored(at, query), self.ids[at])
            below = spans(self.tree.first[now[~leaf]], self.tree.last[now[~leaf]])
            more = self.bounds(below, values, size)
            nodes = np.concatenate([nodes[rest], below])
            upper, lower = (np.concatenate([old[rest], new]) for old, new in zip((upper, lower), more))
            opened *= 2


def vectors_of(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and embedding of the rows that take part; null ids as the last ones."""
    rows = picked(df, vec_id=(id_col, "long"), label=(label_col, "long"), embedding=(vector_col, "array<double>"))
    rows = rows.filter("label IS NOT NULL AND embedding IS NOT NULL")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(~odd).withColumn("vec_id", null_last(F.col("vec_id")))


def blocked(rows: DataFrame, most: int | None, with_tree: bool) -> DataFrame:
    """Vectors of one length each as blocks of `most` rows, or of as many as BLOCK bytes hold, with their trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def out(size: int, rest: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            ids, labels, matrix = (np.concatenate(x) for x in zip(*held[size]))
            full = most or max(64, BLOCK // (8 * max(1, size)))
            at = 0
            while len(ids) - at >= full or rest and at < len(ids):
                i, l, m = ids[at : at + full], labels[at : at + full], matrix[at : at + full]
                at += full
                names = [c.split()[0] for c in BLOCKS.split(", ")]
                if with_tree:
                    order, tree = covered(*augmented(m))
                    arrays = stored(number, i[order], l[order], m[order]) + [pa.array([tree.packed()], pa.binary())]
                    names = [*names, "tree"]
                else:
                    arrays = stored(number, i, l, m)
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                number += 1
            held[size] = [(ids[at:], labels[at:], matrix[at:])]

        for batch in batches:
            sizes = pc.list_value_length(batch["embedding"]).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch["embedding"].flatten().to_numpy(zero_copy_only=False)
            ids, labels = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "label"))
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                matrix = whole(flat[starts[mine][:, None] + np.arange(size)])
                held.setdefault(size, []).append((ids[mine], labels[mine], matrix))
                yield from out(size, False)
        for size in held:
            yield from out(size, True)

    return rows.mapInArrow(run, TREES_SCHEMA if with_tree else BLOCKS)


def passed(trees: DataFrame, sets: DataFrame, shards: int, schema: str, ask) -> DataFrame:
    """Every set of anchors against every tree: `ask(set, trees)` gives rows of the schema. Trees are dealt
    over the shards, each shard's task holds its own and the sets pass by."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    types = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[k] for k in kinds]
    columns = ["size", "ids", "labels", "data", "wide"]
    extra = F.lit(None).cast("array<struct<uid: long, positive: int, positive_id: long, positive_score: long>>")
    held = trees.select(
        F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "number", *columns,
        "tree", extra.alias("windows"),
    )
    asking = sets.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "number", *columns,
        F.lit(None).cast("binary").alias("tree"), F.col("windows") if "windows" in sets.columns else extra.alias("windows"),
    )
    rows = held.union(asking).repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: list[Index] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                if row["kind"] == 0:
                    mine.append(Index(row))
                elif found := ask(row, [t for t in mine if t.rows.shape[1] == row["size"]]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    return rows.mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int | None = None, together: int = SET,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are inner products of the vectors with components floor(256 * x). An anchor's positives are the best
    `positives` vectors of its label, its own id left out, ties to the smaller id. For each of them the best
    `negatives` vectors of other labels are given whose score is from `low` to `high` hundredths of the positive's.

    Rows with a null label, a null vector, or a null or non-finite component take no part on either side. A null id
    is an id like others that sorts last. Vectors of different lengths have no score together. Repeated rows
    are candidates each; anchors that repeat an id are answered each. Empty tables give no rows, further
    columns are ignored. A score among the results that does not fit a long stops the job.
    """
    names = (id_col, vector_col, label_col)
    trees = written(blocked(vectors_of(vectors, *names), block, True), "cover-trees")
    sets = written(blocked(vectors_of(anchors, *names), together, False), "cover-anchors")
    shards = max(partitions(vectors.sparkSession), -(-trees.count() // TREES))

    def ask_positives(row: dict, mine: list[Index]) -> list[tuple]:
        found = []
        for i, (own, label, query) in enumerate(zip(*loaded(row))):
            windows = Windows([-math.inf], [math.inf], positives)
            for index in mine:
                index.search(query, (index.labels == label) & (index.ids != own), windows)
            found += [(row["number"], i, int(own), vec_id, *within_long(score)) for score, vec_id in windows.best[0]]
        return found

    schema = "number long, uid long, anchor_id long, positive_id long, positive_score long, wide boolean"
    near = passed(trees, sets, shards, schema, ask_positives)
    order = Window.partitionBy("number", "uid").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("positive", F.row_number().over(order)).filter(F.col("positive") <= positives)
    near = near.withColumn("positive_score", checked("positive_score", "wide"))
    asked = near.groupBy("number").agg(
        F.collect_list(F.struct("uid", "positive", "positive_id", "positive_score")).alias("windows")
    )
    # One list of at most `together` times `positives` windows for each set.
    with_windows = written(sets.join(asked, "number"), "cover-windows")

    def ask_negatives(row: dict, mine: list[Index]) -> list[tuple]:
        found, by_anchor = [], {}
        for w in sorted(row["windows"], key=lambda w: (w["uid"], w["positive"])):
            by_anchor.setdefault(w["uid"], []).append(w)
        ids, labels, matrix = loaded(row)
        for i, asks in by_anchor.items():
            scores = [w["positive_score"] for w in asks]
            windows = Windows([-(-low * s // 100) for s in scores], [high * s // 100 for s in scores], negatives)
            for index in mine:
                index.search(matrix[i], index.labels != labels[i], windows)
            for w, best in zip(asks, windows.best):
                found += [
                    (row["number"], i, w["positive"], int(ids[i]), w["positive_id"], w["positive_score"], vec_id, score)
                    for score, vec_id in best
                ]
        return found

    schema = (
        "number long, uid long, positive int, anchor_id long, positive_id long, positive_score long, negative_id long, "
        "negative_score long"
    )
    far = passed(trees, with_windows, shards, schema, ask_negatives)
    order = Window.partitionBy("number", "uid", "positive").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    null_id = lambda c: F.when(F.col(c) != int(LAST_ID), F.col(c)).alias(c)
    return far.select(
        null_id("anchor_id"), null_id("positive_id"), "rank", null_id("negative_id"), "positive_score", "negative_score"
    )
