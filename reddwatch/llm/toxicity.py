"""Toxicity scores from non-negative positive-unlabelled learning.

The classifiers see confirmed toxic texts and texts without a label only. With the share p of toxic texts
among all, the risk of taking clean texts for toxic is the risk over unlabelled texts less p times that
over toxic ones; where a classifier fits so well that this estimate falls below zero, the step goes back
instead, which keeps it from learning the unlabelled toxic texts by heart.

Words are seen as themselves, their beginnings and their ends, hashed. Which of them occur more often in
toxic texts than in all is counted over every row outside the held-out ones; the classifiers get the FEATURES
most telling ones. Only what they are fitted on is bounded (POSITIVE, UNLABELLED, and COVER texts for each
feature that these have too seldom); scoring covers every whole text.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reddwatch.llm.common import documents, picked, written

# Bounds of the samples that the classifiers are fitted on, and of what they look at.
POSITIVE, UNLABELLED, FEATURES = 4_000, 12_000, 4_000
# A feature that fewer of the toxic texts drawn have gets so many further ones.
COVER = 20
# Rows of the batches that counts leave a task in.
ROWS = 65_536
SLOTS = 1 << 21
CLASSIFIERS, STEPS, RATE, DECAY = 3, 300, 0.05, 1e-4
# A feature is taken if its share in toxic texts is SURE standard errors above that in unlabelled texts,
# which is rare by chance even among millions of features, and it is in at least LEAST toxic ones.
SURE, LEAST = 4.0, 3
# What only toxic texts have is 1 / (share of toxic texts) times as often in them as in unlabelled ones; a
# feature must come to this part of it, so that words that clean texts have too stay out.
PURE = 0.35
WORDS = 200_000
_MARKS = " .,;:!?\"'()[]{}<>*%$&#-_/\\|~`+=…«»“”‘’¿¡"


class Features(dict):
    """The numbers of a raw word's features, remembered."""

    def __init__(self, chosen: np.ndarray | None = None):
        super().__init__()
        self.chosen = None if chosen is None else {int(f): i for i, f in enumerate(chosen)}

    def __missing__(self, raw: str) -> tuple[int, ...]:
        word = raw.strip(_MARKS)
        parts = {f"={word}"} | {f"^{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n}
        parts |= {f"{word[-n:]}$" for n in (4, 5) if len(word) > n}
        found = [zlib.crc32(p.encode()) % SLOTS for p in parts] if word else []
        if self.chosen is not None:
            found = [self.chosen[f] for f in found if f in self.chosen]
        if len(self) > WORDS:
            self.clear()
        self[raw] = tuple(found)
        return self[raw]

    def of(self, text: str) -> list[tuple[int, ...]]:
        """Features of the words of a text, for words that have any."""
        return [f for f in map(self.__getitem__, text.lower().split()) if f]


def vector(features: Features, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The chosen features of a text and the logarithm of how often they occur."""
    found = [x for f in features.of(text) for x in f]
    columns, times = np.unique(np.array(found, dtype=np.int64), return_counts=True)
    return columns, np.log1p(times)


@dataclass
class Model:
    chosen: np.ndarray  # slots of the features
    weights: np.ndarray  # one row for each classifier
    biases: np.ndarray

    def score(self, columns: np.ndarray, values: np.ndarray) -> float:
        margin = self.weights[:, columns] @ values + self.biases
        return float(np.mean(1 / (1 + np.exp(-np.clip(margin, -40, 40)))))


def fit(
    positive: list[tuple[np.ndarray, np.ndarray]], unlabelled: list[tuple[np.ndarray, np.ndarray]],
    prior: float, size: int, seed: int, further: list[tuple[np.ndarray, np.ndarray]] | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier with the least corrected risk, under the sigmoid loss.

    `further` are toxic texts that were not drawn at random: they count where a toxic text is called clean, but
    not in the correction, which needs the shares that features really have.
    """
    both = positive + unlabelled + (further or [])
    rows = np.repeat(np.arange(len(both)), [len(c) for c, _ in both])
    columns = np.concatenate([c for c, _ in both]) if rows.size else np.zeros(0, dtype=np.int64)
    values = np.concatenate([v for _, v in both]) if rows.size else np.zeros(0)
    rng = np.random.default_rng(seed)
    # Each classifier sees its own draw of the unlabelled texts.
    seen = rng.poisson(1.0, len(unlabelled)).astype(float)
    seen = seen / max(seen.sum(), 1.0)
    p, u, toxic = np.zeros(len(both)), np.zeros(len(both)), np.zeros(len(both))
    p[: len(positive)] = 1 / len(positive)
    u[len(positive) : len(positive) + len(unlabelled)] = seen
    toxic[: len(positive)] = toxic[len(positive) + len(unlabelled) :] = 1 / len(positive)
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    m, s = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(rows, values * w[columns], len(both)) + b
        up = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        # The sigmoid loss: `up` is the loss of calling it clean, 1 - up that of calling it toxic.
        clean_risk = ((u - prior * p) * up).sum()
        slope_clean = (u - prior * p) * up * (1 - up)
        slope = -slope_clean if clean_risk < 0 else slope_clean - prior * toxic * up * (1 - up)
        gradient = np.append(np.bincount(columns, values * slope[rows], size) + DECAY * w, slope.sum())
        m = 0.9 * m + 0.1 * gradient
        s = 0.999 * s + 0.001 * gradient**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Classifiers fitted on the labels outside the held-out rows; None without any toxic one.

    `docs` has doc_id and text, `labels` doc_id and toxic. Which rows are in the samples follows from a
    hash of their id alone, and of repeated rows the one with the least text. Counts take each row as it is. An id
    with several labels is toxic if one of them says so. The share of toxic texts among all is taken to be that
    among the labels, which should be drawn like the documents.
    """
    order = F.xxhash64("doc_id")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    if not share:
        return None
    prior = min(max(share, 1e-3), 0.999)
    toxic = written(known.filter("toxic = 1").select("doc_id"), "toxicity-labels")
    outside = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        times = np.zeros((2, SLOTS), dtype=np.int32)
        rows = np.zeros(2, dtype=np.int64)
        for batch in batches:
            for text, positive in zip(batch["text"].to_pylist(), batch["positive"].to_pylist()):
                found = chain.from_iterable(map(features.__getitem__, set(text.lower().split())))
                slots = np.fromiter(found, dtype=np.int64)
                # A slot that is there more than once goes up by one all the same.
                times[1, slots] += 1
                rows[1] += 1
                if positive:
                    times[0, slots] += 1
                    rows[0] += 1
        used = np.flatnonzero(times[1])
        # Slot -1 has the numbers of rows.
        columns = [
            np.append(used, -1), np.append(times[0, used].astype(np.int64), rows[0]),
            np.append(times[1, used].astype(np.int64), rows[1]),
        ]
        for at in range(0, len(used) + 1, ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + ROWS]) for c in columns], names=["slot", "p", "u"])

    marked = outside.join(toxic.withColumn("positive", F.lit(1)), "doc_id", "left").select("text", "positive")
    counted = marked.mapInArrow(count, "slot long, p long, u long").groupBy("slot").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")
    )
    counted = written(counted, "toxicity-counts")
    n_p, n_u = counted.filter("slot = -1").select("p", "u").first() or (0, 0)
    if not n_p or not n_u:
        return None
    in_p, in_u = F.col("p") / F.lit(n_p), F.col("u") / F.lit(n_u)
    pooled = (F.col("p") + F.col("u")) / F.lit(n_p + n_u)
    told = (in_p - in_u) / F.sqrt((pooled * (1 - pooled) + 1e-9) * F.lit(1 / n_p + 1 / n_u))
    best = (
        counted.filter((F.col("slot") >= 0) & (F.col("p") >= LEAST) & (told >= SURE))
        .filter(in_p >= max(1.2, PURE / prior) * in_u)
        .orderBy(told.desc(), "slot").limit(FEATURES).select("slot").collect()
    )
    if not best:
        return None
    chosen = np.array(sorted(r.slot for r in best), dtype=np.int64)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(chosen)
        for batch in batches:
            found = [vector(features, t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([c.astype("<i4").tobytes() for c, _ in found], pa.binary()),
                    pa.array([v.astype("<f8").tobytes() for _, v in found], pa.binary()),
                ],
                names=["doc_id", "columns", "values"],
            )

    def drawn(ids: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """The vectors of a bounded number of ids."""
        texts = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
        rows = texts.mapInArrow(vectors, "doc_id long, columns binary, values binary").collect()
        rows.sort(key=lambda r: r.doc_id)
        return {r.doc_id: (np.frombuffer(r["columns"], "<i4"), np.frombuffer(r["values"], "<f8")) for r in rows}

    base = drawn(outside.select("doc_id").join(toxic, "doc_id", "left_semi").distinct().orderBy(order).limit(POSITIVE))
    unlabelled = drawn(outside.select("doc_id").distinct().orderBy(order).limit(UNLABELLED))
    held = np.bincount(np.concatenate([c for c, _ in base.values()]), minlength=len(chosen))
    seldom = (held < COVER) if n_p > len(base) else np.zeros(len(chosen), dtype=bool)

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each feature that is seldom drawn, the COVER first of a task's texts that have it."""
        features = Features(chosen)
        first: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for batch in batches:
            for doc_id, place, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "place", "text"))):
                columns = vector(features, text)[0]
                for c in columns[seldom[columns]].tolist():
                    if (-place, doc_id) in first[c]:
                        continue
                    if len(first[c]) < COVER:
                        heapq.heappush(first[c], (-place, doc_id))
                    else:
                        heapq.heappushpop(first[c], (-place, doc_id))
        rows = [(c, -place, doc_id) for c, heap in first.items() for place, doc_id in heap]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows)], names=["feature", "place", "doc_id"]
            )

    further = {}
    if seldom.any():
        found = outside.join(toxic, "doc_id", "left_semi").select("doc_id", order.alias("place"), "text").mapInArrow(
            holders, "feature long, place long, doc_id long"
        ).distinct()
        rank = F.row_number().over(Window.partitionBy("feature").orderBy("place", "doc_id"))
        ids = written(found.withColumn("rank", rank).filter(F.col("rank") <= COVER).select("doc_id").distinct(), "toxicity-further")
        further = {i: v for i, v in drawn(ids).items() if i not in base}
    parts = [list(x.values()) for x in (base, unlabelled, further)]
    fitted = [fit(parts[0], parts[1], prior, len(chosen), seed, parts[2]) for seed in range(CLASSIFIERS)]
    return Model(chosen, np.stack([w for w, _ in fitted]), np.array([b for _, b in fitted]))


def scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
    id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
) -> DataFrame:
    """Per row of docs doc_id, held_out, score and predicted (1 from the threshold on).

    A null text counts as empty and is scored like one; null ids stay null and are never learnt from;
    labels with a null id or mark do not count; repeated rows have a row each; an empty table gives no rows. If
    no row outside the held-out ones is labelled toxic, or none of those is in docs, every score is 0.
    """
    texts = documents(docs, id_col, text_col)
    model = learn(texts, picked(labels, doc_id=(id_col, "long"), toxic=(toxic_col, "int")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.chosen) if model else None
        for batch in batches:
            found = [model.score(*vector(features, t)) if model else 0.0 for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], batch["held_out"], pa.array(found, pa.float64()),
                    pa.array([int(s >= threshold) for s in found], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return texts.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def kept(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of docs with all their columns, without those that `scores` predicts to be toxic."""
    model = learn(documents(docs, id_col, text_col), picked(labels, doc_id=("doc_id", "long"), toxic=("toxic", "int")))
    if model is None:
        return docs
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.chosen)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            clean = [model.score(*vector(features, t or "")) < threshold for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
