"""Near duplicates by SimHash fingerprints and a hierarchical index in Gray order.

An index node holds the bits that all fingerprints under it share and no node above it holds; a search
adds up the differences on its way down and leaves a node, with all that is under it, once there are too
many. The upper nodes are spread over the cluster: of k + 2 bands of bits two agree between fingerprints
with at most k differing bits, so each fingerprint goes to a node for every pair of bands, named by the
bits it has there. A node with more than HOT fingerprints gets nodes of the same kind under it, over the
bits left, down to nodes that cannot hold more. Within a node, fingerprints are sorted by Gray rank, so
that neighbours share most bits, and runs of them are joined into a tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reddwatch.llm.common import documents, null_last, partitions, written
from reddwatch.llm.components import components

SEED = 42
HOT = 4096
# Children of a node, and fingerprints searched for at once.
FAN, TOGETHER = 8, 512
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, words: int = 3) -> int:
    """64 bits: a bit is set if it is in over half the XXH64 values of the text's word shingles."""
    tokens = text.encode().translate(_LOWER).split()  # splits at \x20 and \x09 to \x0d
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(values), 65_536):
        part = values[i : i + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.array(found, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "fp"],
            )

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray code."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def submasks(mask: int, distance: int) -> list[int]:
    """`mask` with any two of the distance + 2 bands of the bits that it leaves."""
    free = [b for b in range(64) if not mask >> b & 1]
    bands = np.array_split(np.array(free), distance + 2)
    bits = [sum(1 << int(b) for b in band) for band in bands]
    return [mask | x | y for x, y in combinations(bits, 2)]


class Tree:
    """Fingerprints sorted by Gray rank under nodes of FAN children each."""

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        # From the leaves up: which bits all under a node share, and what they are.
        masks, patterns = [np.full(len(values), ~np.uint64(0))], [self.values]
        while len(masks[-1]) > FAN:
            m, p = masks[-1], patterns[-1]
            first = np.arange(0, len(m), FAN)
            ones = np.bitwise_and.reduceat(p | ~m, first) & np.bitwise_and.reduceat(m, first)
            zeros = np.bitwise_and.reduceat(~p | ~m, first) & np.bitwise_and.reduceat(m, first)
            masks.append(ones | zeros)
            patterns.append(ones)
        # A node keeps only what the node above it doesn't have.
        self.levels = []
        for i, (m, p) in enumerate(zip(masks, patterns)):
            if i + 1 < len(masks):
                m = m & ~masks[i + 1][np.arange(len(m)) // FAN]
            self.levels.append((m, p & m))

    def near(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of values within the distance."""
        top = len(self.levels[-1][0])
        who = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        far = np.zeros(len(who), dtype=np.uint8)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[level]
            far = far + np.bitwise_count((queries[who] ^ pattern[node]) & mask[node])
            kept = far <= distance
            who, node, far = who[kept], node[kept], far[kept]
            if level:
                below = len(self.levels[level - 1][0])
                who, far = np.repeat(who, FAN), np.repeat(far, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                real = node < below
                who, node, far = who[real], node[real], far[real]
        return who, node


def spanning(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within the distance, directly or over others: each value to the least
    of its component, not all pairs."""
    tree = Tree(values)
    label = np.arange(len(values))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = int(label[i])
        return i

    for i in range(0, len(values), TOGETHER):
        who, node = tree.near(tree.values[i : i + TOGETHER], distance)
        who = who + i
        later = node > who
        for a, b in zip(who[later].tolist(), node[later].tolist()):
            if (x := root(a)) != (y := root(b)):
                label[max(x, y)] = min(x, y)
    roots = np.array([root(i) for i in range(len(values))], dtype=np.int64)
    linked = roots != np.arange(len(values))
    return tree.values[linked], tree.values[roots[linked]]


def links(fps: DataFrame, distance: int, hot: int = HOT) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) whose components are those of all pairs
    with at most `distance` differing bits."""
    spark = fps.sparkSession
    schema = "fp long, mask long, bits long"

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy().view(np.uint64)
            mask = batch["mask"].to_numpy().view(np.uint64)
            for m in np.unique(mask):
                mine = fp[mask == m]
                for sub in submasks(int(m), distance):
                    s = np.uint64(sub)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)) for x in (mine, np.full(len(mine), s), mine & s)],
                        names=["fp", "mask", "bits"],
                    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema=pa.schema([(c, pa.int64()) for c in ("fp", "mask", "bits")]))
        if not rows.num_rows:
            return
        fp, mask, bits = (rows[c].to_numpy() for c in ("fp", "mask", "bits"))
        order = np.lexsort((bits, mask))
        fp, mask, bits = fp[order].view(np.uint64), mask[order], bits[order]
        new = np.ones(len(fp) + 1, dtype=bool)
        new[1:-1] = (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])
        cuts = np.flatnonzero(new)
        a, b = [], []
        for i in np.flatnonzero(np.diff(cuts) > 1).tolist():
            x, y = spanning(fp[cuts[i] : cuts[i + 1]], distance)
            a.append(x)
            b.append(y)
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

    found = None
    level = fps.select("fp").distinct().withColumn("mask", F.lit(0).cast("long"))
    free = 64
    while True:
        rows = level.mapInArrow(routed, schema)
        # Nodes under different hot ones may be the same.
        rows = written(rows if found is None else rows.distinct(), "simhash-nodes")
        # Two of the bands are fixed now; what is left bounds the size of a node.
        free -= sum(len(x) for x in np.array_split(np.arange(free), distance + 2)[-2:])
        large = None
        if 2**free > hot and free >= 2 * (distance + 2):
            large = written(
                rows.groupBy("mask", "bits").count().filter(F.col("count") > hot).select("mask", "bits"), "simhash-hot"
            )
            rows_here = rows.join(large, ["mask", "bits"], "left_anti")
        else:
            rows_here = rows
        part = rows_here.repartition(partitions(spark), "mask", "bits").select("fp", "mask", "bits").mapInArrow(
            joined, "a long, b long"
        )
        found = part if found is None else found.union(part)
        if large is None or large.isEmpty():
            return found
        level = rows.join(large, ["mask", "bits"], "left_semi").select("fp", "mask")


def near_duplicates(
    docs: DataFrame, words: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text",
    hot: int = HOT,
) -> DataFrame:
    """Per row doc_id, fingerprint (16 hexadecimal digits) and component_id.

    Rows whose fingerprints differ in at most `distance` bits are linked; component_id is the smallest
    doc_id of all that are linked directly or over others. A null text counts as empty; texts without a
    word have the fingerprint zero and are linked like any other. Null ids stay null, and a component
    with no other ids has a null component_id. Repeated rows have a row each. An empty table gives no
    rows, further columns are ignored.
    """
    rows = written(fingerprints(docs, words, id_col, text_col), "simhash-fingerprints")
    classes = _classes(rows, distance, hot).select("fp", F.col("first.least").alias("component_id"))
    last = null_last(F.lit(None).cast("long"))
    return rows.join(classes, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("component_id") != last, F.col("component_id")).alias("component_id"),
    )


def _classes(rows: DataFrame, distance: int, hot: int) -> DataFrame:
    """fp and first: of each fingerprint the least id and its fingerprint in the component."""
    least = written(rows.groupBy("fp").agg(F.min(null_last(F.col("doc_id"))).alias("least")), "simhash-least")
    roots = written(components(links(least, distance, hot)).distinct(), "simhash-roots")
    own = F.struct("least", "fp")
    first = roots.join(least, F.col("vertex") == F.col("fp")).groupBy("root").agg(F.min(own).alias("of_root"))
    linked = roots.join(first, "root").select(F.col("vertex").alias("fp"), "of_root")
    return written(
        least.join(linked, "fp", "left").select("fp", F.coalesce("of_root", own).alias("first")), "simhash-classes"
    )


def representatives(
    docs: DataFrame, words: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text",
    hot: int = HOT,
) -> DataFrame:
    """One row of each component, with all columns of docs: that with the smallest id, a null one being the
    largest, and of rows that repeat it with the same fingerprint the one with the smallest text."""
    first = _classes(
        written(fingerprints(docs, words, id_col, text_col), "simhash-fingerprints"), distance, hot
    ).select(F.col("first.least").alias("_least"), F.col("first.fp").alias("_of")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["row"].field(text_col).to_pylist()
            found = [fingerprint(t or "", words) for t in texts]
            values = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["row"], values], names=["row", "fp"])

    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = whole.mapInArrow(run, T.StructType([*whole.schema.fields, T.StructField("fp", T.LongType())]))
    rows = rows.withColumn("id", null_last(F.col("row").getField(id_col).cast("long")))
    kept = rows.join(first, (F.col("fp") == F.col("_of")) & (F.col("id") == F.col("_least")))
    text = F.col("row").getField(text_col).asc_nulls_first()
    one = F.row_number().over(Window.partitionBy("_of", "_least").orderBy(text))
    return kept.withColumn("one", one).filter("one = 1").select("row.*")
