"""Packing of token streams into sequences by dynamic programming over possible cuts."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from reddwatch.llm.common import documents
from reddwatch.llm.tokens import encoder_of

# Costs in tokens of padding: a sequence more, a cut inside a document after a sentence, any other cut.
SEQUENCE, SENTENCE, INSIDE = 1, 1, 8
# Without a better place, cuts are possible at every STEP-th token.
STEP = 16
# Tokens planned at once; the sequence that is not full by then goes on with the next ones.
BLOCK = 1_000_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def possible_cuts(ids: np.ndarray, ends: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream may be cut, 0 and its end included, and what each cut costs.

    `ends` are the ends of documents, `marks` tells for each id whether a sentence ends with it.
    """
    n = len(ids)
    cost = np.full(n + 1, -1, dtype=np.int8)
    cost[np.flatnonzero(marks[ids]) + 1] = SENTENCE
    cost[ends] = 0
    cost[0] = cost[n] = 0
    at = np.flatnonzero(cost >= 0)
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > 2 * STEP)
    if len(wide):
        more = [np.arange(at[i] + STEP, at[i + 1], STEP) for i in wide]
        cost[np.concatenate(more)] = INSIDE
        at = np.flatnonzero(cost >= 0)
    return at, cost[at].astype(np.int64)


def cuts_at_powers(at: np.ndarray, size: int) -> tuple[list[int], list[int]]:
    """For each cut the earlier ones at a power of two below `size` before it, nearest first, one list after
    another, and where each cut's list begins."""
    index = np.full(int(at[-1]) + 1, -1, dtype=np.int32)
    index[at] = np.arange(len(at))
    cuts, before = [], []
    power = 1
    while power < size:
        far = int(np.searchsorted(at, power))
        found = index[at[far:] - power]
        there = np.flatnonzero(found >= 0)
        cuts.append(there + far)
        before.append(found[there])
        power *= 2
    cut = np.concatenate(cuts) if cuts else np.zeros(0, dtype=np.int64)
    order = np.argsort(cut, kind="stable")
    bounds = np.searchsorted(cut[order], np.arange(len(at) + 1))
    return (np.concatenate(before)[order].tolist() if cuts else []), bounds.tolist()


def best_cuts(at: np.ndarray, cost: np.ndarray, size: int) -> list[int]:
    """The cuts (as indices of `at`, first and last included) with the least padding and cost.

    A sequence from cut i to cut k, of at most `size` tokens, takes size - (at[k] - at[i]) of padding,
    none at a power of two. For the first kind the least of best[i] + at[i] over the cuts in reach is
    wanted, which a monotone queue keeps; for the second kind each power of two names one cut.
    """
    m = len(at)
    exact, bounds = cuts_at_powers(at, size)
    places, costs = at.tolist(), cost.tolist()
    best, before = [0] * m, [0] * m
    queue = deque([(0, 0, 0)])  # best + place, place, index
    for k in range(1, m):
        place = places[k]
        while queue[0][1] < place - size:
            queue.popleft()
        least, _, come = queue[0]
        least += size - place
        for i in exact[bounds[k] : bounds[k + 1]]:
            if best[i] < least:
                least, come = best[i], i
        least += costs[k] + SEQUENCE
        best[k], before[k] = least, come
        key = least + place
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, place, k))
    path = [m - 1]
    while path[-1]:
        path.append(before[path[-1]])
    return path[::-1]


class Packer:
    """Takes documents in order and gives the pieces of finished sequences."""

    def __init__(self, marks: np.ndarray, size: int, first: int, block: int = BLOCK):
        self.marks, self.size, self.sequence, self.block = marks, size, first, block
        self.ids: list[bytes] = []
        self.parts: list[list[int]] = []  # document id, start in it, length here, its length
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        n = len(ids) // 4
        self.ids.append(ids)
        self.parts.append([doc_id, 0, n, n])
        self.held += n
        return self.plan(False) if self.held >= self.block else []

    def plan(self, last: bool) -> list[tuple]:
        if not self.held:
            return []
        data = b"".join(self.ids)
        ids = np.frombuffer(data, dtype="<u4")
        ends = np.cumsum([p[2] for p in self.parts])
        at, cost = possible_cuts(ids, ends, self.marks)
        path = best_cuts(at, cost, self.size)
        cuts = at[path].tolist()
        if not last and len(cuts) > 2:
            cuts.pop()  # what comes next may fill it
        rows, part, begin = [], 0, 0  # begin: where the part begins in the data
        for a, b in zip(cuts, cuts[1:]):
            while a < b:
                doc_id, start, length, total = self.parts[part]
                end = min(b, begin + length)
                rows.append((
                    doc_id, start + a - begin, end - a, zlib.crc32(data[4 * a : 4 * end]), total,
                    self.sequence, a,
                ))
                if end == begin + length:
                    part, begin = part + 1, end
                a = end
            self.sequence += 1
        done = cuts[-1]
        rows = self.with_offsets(rows, cuts)
        rest = []
        for i in range(part, len(self.parts)):
            doc_id, start, length, total = self.parts[i]
            used = max(0, done - begin)
            rest.append([doc_id, start + used, length - used, total])
            begin += length
        self.parts, self.ids, self.held = rest, [data[4 * done :]], len(ids) - done
        return rows

    def with_offsets(self, rows: list[tuple], cuts: list[int]) -> list[tuple]:
        first = self.sequence - (len(cuts) - 1)
        return [(*row[:6], row[6] - cuts[row[5] - first]) for row in rows]


def packed(
    docs: DataFrame, path: str, size: int = 1024, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 0, block: int = BLOCK,
) -> DataFrame:
    """Per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each task packs the documents of its partition in their order, so nothing is shuffled. A document
    is its ids and `end_id`; a null or empty text is `end_id` alone. Null ids stay null, repeated rows are
    packed as often as they come, an empty table gives no rows, further columns are ignored. Only the
    last sequences of a task meet the end of its documents; the plan may then cut at powers of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = encoder.raw([end_id])
        packer = Packer(encoder.sentence_ends(), size, TaskContext.get().partitionId() << 33, block)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for doc_id, text in zip(ids, texts):
                if rows := packer.add(doc_id, encoder.encode(text) + end):
                    yield out(rows)
        while packer.held:
            yield out(packer.plan(True))

    return documents(docs, id_col, text_col).mapInArrow(run, PIECES)
