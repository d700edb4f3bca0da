"""Removal of repeated passages by refining buckets of q-grams.

Suffixes are put into buckets by their first Q bytes, and buckets are refined by the identifiers of
later offsets: the identifier of 2Q bytes is made of those of Q bytes at 0 and Q, that of LENGTH bytes
of those of 2Q bytes at 0 and LENGTH - 2Q (or is that of 2Q bytes), so each step uses what the last one has found. Three things
keep this in proportion to the input on many machines:

- Only one suffix in each window of LENGTH - Q + 1 enters a bucket, the one with the least scrambled
  identifier. Equal strings of LENGTH bytes choose the same place, so none is missed.
- A bucket is refined first by the identifiers of all that its suffix's windows cover. Whoever has a
  class in common with a smaller document is repeated as a whole; copies never get beyond this step.
- Only buckets that still hold several classes are refined to single strings, one entry for each class.

Texts lie as compressed chunks of about a MB in a table in the shared folder; a longer document is a chunk of
its own that is looked at piece by piece. Buckets travel as packed arrays, one for each chunk and bucket, in which
a chunk has each class at most once, so a string that fills a third of all documents has an entry for each chunk
and not for each place. The number of buckets follows the bytes of what travels, and a task has one of them in
memory at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import LAST_ID, mixed, pack, partitions, picked, squeeze, unsqueeze, written

# Text bytes of a chunk, and of the pieces in which a longer document is looked at.
CHUNK = 1 << 20
# Bytes of packed arrays that meet in a bucket, and of one entry of them.
BUCKET, ENTRY = 8 << 20, 14
LENGTH = 50
# Long enough that different passages seldom share a bucket, however large the corpus.
Q = 25

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _FACTOR)

# Chunks have part 0 and their bytes as size, replies higher parts and the number of classes still open.
CHUNKS = "chunk long, part long, size long, meta binary, data binary"
BLOBS = "bucket long, chunk long, part long, data binary"


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """Polynomials of the q bytes from each place on, by doubling; 64 bits. `mixed` makes identifiers of them."""
    with np.errstate(over="ignore"):
        power = [_FACTOR]  # of 1, 2, 4 ... bytes
        level, width = _BYTES[data], 1
        whole, done = None, 0
        while True:
            if q & width:
                if whole is None:
                    whole, done = level, width
                else:
                    # `level` of this width in front of the `done` bytes taken so far
                    n = len(data) - done - width + 1
                    shift = np.uint64(pow(int(_FACTOR), done, 1 << 64))
                    whole = level[:n] * shift + whole[width : width + n]
                    done += width
            if done == q:
                return whole
            n = len(data) - 2 * width + 1
            level = level[:n] * power[-1] + level[width : width + n]
            power.append(power[-1] * power[-1])
            width *= 2


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The identifier of two identifiers in their order."""
    with np.errstate(over="ignore"):
        return mixed(first * _OTHER + (second ^ (second >> np.uint64(29))) * _FACTOR)


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values the place of the one with the least scrambled upper half, the leftmost of
    equals."""
    with np.errstate(over="ignore"):
        key = values * _OTHER
    key &= np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(len(values), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    return key.astype(np.uint32)


@dataclass
class Entries:
    """The chosen suffixes of some bytes: which windows (their starts) chose them, and their identifiers."""

    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray
    cover: np.ndarray
    owner: np.ndarray
    strings: Strings

    def __len__(self) -> int:
        return len(self.low)


@dataclass
class Strings:
    """Identifiers of the strings of `length` bytes, made of those of shorter ones at later offsets."""

    grams: np.ndarray
    length: int
    q: int

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The identifiers of the strings that start there, and those of their 2Q bytes (Q, if that is half)."""
        gram = lambda offset: mixed(self.grams[places + offset])
        first = gram(0)
        if self.length == 2 * self.q:
            return joined(first, gram(self.q)), first  # the pair still names both halves
        half = joined(first, gram(self.q))
        later = self.length - 2 * self.q
        return joined(half, joined(gram(later), gram(later + self.q))), half


def entries(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, length: int, q: int) -> Entries:
    """Of the documents that lie one after another in `data`."""
    none = np.zeros(0, dtype=np.uint64)
    if len(data) < length:
        place = np.zeros(0, dtype=np.int64)
        return Entries(place, place, none, none, place, Strings(none, length, q))
    strings = Strings(grams(data, q), length, q)
    chosen = least_places(strings.grams, length - q + 1)
    ends = np.cumsum(sizes)
    whole = np.ones(len(chosen), dtype=bool)  # windows within one document
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        whole[max(a, b - length + 1) : b] = False
    # A run of windows with one choice: begins where the choice or the document is new.
    new = np.ones(len(chosen) + 1, dtype=bool)
    np.not_equal(chosen[1:], chosen[:-1], out=new[1:-1])
    new[1:] |= ~whole
    low = np.flatnonzero(whole & new[:-1])
    high = np.flatnonzero(whole & (new[1:] | np.append(~whole[1:], True)))
    at = chosen[low].astype(np.int64)
    shape = ((at - low) * 1024 + (high - low)).astype(np.uint64)
    cover = joined(joined(strings.at(low)[0], strings.at(high)[0]), mixed(shape))
    owner = ids[np.searchsorted(ends, low, side="right")]
    return Entries(low, high, mixed(strings.grams[at]), cover, owner, strings)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the key, so that sorted keys are sorted by bucket too."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


@dataclass
class Classes:
    """Pairs of keys with the least document that has them, sorted, and the class of each entry."""

    first: np.ndarray
    second: np.ndarray
    least: np.ndarray
    of_entry: np.ndarray


def classes(first: np.ndarray, second: np.ndarray, owner: np.ndarray) -> Classes:
    order = np.lexsort((owner, second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    of_entry = np.empty(len(order), dtype=np.int64)
    of_entry[order] = np.cumsum(new) - 1
    return Classes(a[new], b[new], owner[order][new], of_entry)


def packed_ids(ids: np.ndarray) -> bytes:
    """Identifiers as differences from the least one, in as few bytes as they need."""
    low, high = int(ids.min()), int(ids.max())
    kind = next((k for k in ("u1", "u2", "u4") if high - low < 1 << (8 * int(k[1]))), "u8")
    head = np.array([low, int(kind[1])], dtype="<i8").tobytes()
    return head + (ids.view(np.uint64) - np.uint64(low & (1 << 64) - 1)).astype("<" + kind).tobytes()


def blobs(chunk: int, piece: int, found: Classes, buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """For each bucket that occurs its number, the chunk, the part of the reply, and the classes' low 40 bits of the
    first key, second key, document."""
    number = bucket_of(found.first, buckets)
    cuts = np.flatnonzero(np.diff(number)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(number)]):
        if a == b:
            continue
        key = found.first[a:b]
        yield (
            int(number[a]), chunk, piece * buckets + int(number[a]) + 1,
            np.array([b - a], dtype="<i8").tobytes() + pack(key.astype(np.uint32))
            + pack((key >> np.uint64(32)).astype(np.uint8)) + pack(found.second[a:b])
            + packed_ids(found.least[a:b]),
        )


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    low = np.frombuffer(data, np.uint32, n, 8).astype(np.uint64)
    key = low | np.frombuffer(data, np.uint8, n, 8 + 4 * n).astype(np.uint64) << np.uint64(32)
    second = np.frombuffer(data, np.uint64, n, 8 + 5 * n)
    base, width = (int(x) for x in np.frombuffer(data, "<i8", 2, 8 + 13 * n))
    ids = np.frombuffer(data, f"<u{width}", n, 24 + 13 * n).astype(np.uint64)
    return key, second, (ids + np.uint64(base & (1 << 64) - 1)).view(np.int64)


def refined(key: np.ndarray, second: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each class of a chunk: 1 if a smaller document has it, 2 if it has not but its bucket holds
    other classes of other documents, else 0."""
    order = np.lexsort((owner, second, key))
    k, s, o = key[order], second[order], owner[order]
    bucket = np.ones(len(k), dtype=bool)
    bucket[1:] = k[1:] != k[:-1]
    kind = bucket.copy()
    kind[1:] |= s[1:] != s[:-1]
    kinds = np.cumsum(kind) - 1
    buckets = np.cumsum(bucket) - 1
    firsts = np.flatnonzero(bucket)
    several = (np.add.reduceat(kind.astype(np.int64), firsts) > 1) & (
        np.minimum.reduceat(o, firsts) != np.maximum.reduceat(o, firsts)
    )
    least = o[np.flatnonzero(kind)][kinds]
    code = np.where(o > least, 1, np.where(several[buckets], 2, 0)).astype(np.uint8)
    result = np.empty(len(k), dtype=np.uint8)
    result[order] = code
    return result


def chunks_of(docs: DataFrame, id_col: str, text_col: str, carry: list[str], chunk: int) -> DataFrame:
    """The documents as chunks: `meta` has ids, sizes and carried columns, `data` the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        number = 0
        held: list[pa.Table] = []
        texts: list[bytes] = []
        size = 0

        def out() -> pa.RecordBatch:
            meta = pa.concat_tables(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, meta.schema) as writer:
                writer.write_table(meta)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([first + number], pa.int64()), pa.array([0], pa.int64()), pa.array([size], pa.int64()),
                    pa.array([squeeze(sink.getvalue().to_pybytes())], pa.binary()),
                    pa.array([squeeze(b"".join(texts))], pa.binary()),
                ],
                names=["chunk", "part", "size", "meta", "data"],
            )

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            data = [t.encode() for t in batch["text"].to_pylist()]
            rows = rows.drop_columns(["text"]).append_column("size", pa.array([len(t) for t in data], pa.int64()))
            begin = 0
            for i, text in enumerate(data):
                if size and size + len(text) > chunk:
                    if i > begin:
                        held.append(rows.slice(begin, i - begin))
                    yield out()
                    number, held, texts, size, begin = number + 1, [], [], 0, i
                texts.append(text)
                size += len(text)
            if len(data) > begin:
                held.append(rows.slice(begin))
        if held:
            yield out()

    columns = {"doc_id": (id_col, "long"), "text": (text_col, "string")}
    chosen = picked(docs, **columns, **{f"carried_{i}": (c, docs.schema[c].dataType) for i, c in enumerate(carry)})
    return chosen.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(run, CHUNKS)


class Piece:
    """Bytes of a chunk, from `start` on, with their entries."""

    def __init__(self, start: int, size: int, found: Entries):
        self.start, self.size, self.entries = start, size, found
        self.classes = classes(found.gram, found.cover, found.owner)

    def verdicts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries whose windows are all repeated, and those whose windows must be looked at singly."""
        of = self.classes.of_entry
        smaller = (codes[of] == 1) | (self.entries.owner > self.classes.least[of])
        return smaller, (codes[of] == 2) & ~smaller

    def windows(self, single: np.ndarray) -> tuple[np.ndarray, np.ndarray, Classes]:
        """Starts and documents of the windows of these entries, and their classes."""
        low, high = self.entries.low[single], self.entries.high[single]
        n = high - low + 1
        starts = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        owner = np.repeat(self.entries.owner[single], n)
        return starts, owner, classes(*self.entries.strings.at(starts), owner)


class Chunk:
    """A chunk with its documents and texts, and the codes of each round by part."""

    def __init__(self, number: int, meta: bytes, data: bytes, length: int, q: int, piece: int):
        self.number, self.length, self.q, self.piece = number, length, q, piece
        self.meta = pa.ipc.open_stream(unsqueeze(meta)).read_all()
        self.text = unsqueeze(data)
        self.sizes = self.meta["size"].to_numpy().astype(np.int64)
        self.ids = self.meta["doc_id"].fill_null(int(LAST_ID)).to_numpy().astype(np.int64)
        self.codes: dict[int, list[tuple[int, bytes]]] = {}

    def take(self, part: int, kind: int, data: bytes) -> None:
        self.codes.setdefault(kind, []).append((part, data))

    def coded(self, kind: int, piece: int, buckets: int) -> np.ndarray:
        """The codes of a piece's classes in a round, in their order."""
        mine = [unsqueeze(d) for part, d in sorted(self.codes.get(kind, ())) if (part - 1) // buckets == piece]
        return np.frombuffer(b"".join(mine), np.uint8)

    def pieces(self) -> Iterator[tuple[int, Piece]]:
        """One after another: all of an ordinary chunk, or stretches of a long document, which share a string's
        length but one byte, so that each string starts in one of them."""
        data = np.frombuffer(self.text, dtype=np.uint8)
        if len(self.sizes) > 1 or len(data) <= self.piece:
            found = entries(data, self.sizes, self.ids, self.length, self.q)
            if len(found):
                yield 0, Piece(0, len(data), found)
            return
        for number, start in enumerate(range(0, len(data), self.piece)):
            part = data[start : start + self.piece + self.length - 1]
            found = entries(part, np.array([len(part)]), self.ids, self.length, self.q)
            if len(found):
                yield number, Piece(start, len(part), found)


def gathered(batches: Iterator[pa.RecordBatch], length: int, q: int, piece: int, use) -> Iterator[pa.RecordBatch]:
    """What `use` gives for each chunk with its replies, from rows sorted by chunk and part (the chunk's row is
    first). A chunk is gone before the next one is built."""
    held: list[Chunk] = []
    for batch in batches:
        for i in range(batch.num_rows):
            part, meta, data = batch["part"][i].as_py(), batch["meta"][i].as_py(), batch["data"][i].as_py()
            if part == 0:
                if held:
                    yield from use(held.pop())
                held.append(Chunk(batch["chunk"][i].as_py(), meta, data, length, q, piece))
            else:
                held[0].take(part, int(meta[0]), data)
    if held:
        yield from use(held.pop())


def asked(blobs_: DataFrame, kind: int, n: int) -> DataFrame:
    """Replies to blobs: the codes of their classes, in order, by chunk and part. Buckets are read one by one."""

    def answers(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        parts = [unpacked(data) for _, _, data in rows]
        code = refined(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
        codes = np.split(code, np.cumsum([len(p[0]) for p in parts])[:-1])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([int((c == 2).sum()) for c in codes], pa.int64()),
                pa.array([bytes([kind])] * len(rows), pa.binary()),
                pa.array([squeeze(pack(c)) for c in codes], pa.binary()),
            ],
            names=["chunk", "part", "size", "meta", "data"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch["bucket"][i].as_py()
                if number != bucket and rows:
                    yield answers(rows)
                    rows = []
                bucket = number
                rows.append(tuple(batch[c][i].as_py() for c in ("chunk", "part", "data")))
        if rows:
            yield answers(rows)

    return blobs_.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, CHUNKS)


def removed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, q: int = Q,
    chunk: int = CHUNK, carry: list[str] | None = None, keep: bool = False,
) -> DataFrame:
    """Per document doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, and `kept` if asked for.

    A byte is removed if a string of `length` bytes that covers it also starts in a document with a
    smaller id. `spans` are the maximal removed runs, as start and end in bytes; `kept` is what remains,
    as text without characters of which a part is gone. The `carry` columns come along as fields of `carried`.

    Null texts count as empty and lose nothing. Documents with a null id count as the largest: they lose
    what any other has, and do not take from one another; so do rows that repeat an id. An empty table
    gives no rows. Further columns are ignored, whatever their names.
    """
    if not 2 * q <= length <= 4 * q:
        raise ValueError("length must be from 2 to 4 times q")
    carry = carry or []
    spark = docs.sparkSession
    n = partitions(spark)
    chunks = written(chunks_of(docs, id_col, text_col, carry, chunk), "repeats-chunks")

    def buckets_for(rows: DataFrame, share: float) -> int:
        """Buckets for `share` entries for each unit of the rows' size."""
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        return max(n, math.ceil(total * share * ENTRY / BUCKET))

    def with_replies(*replies: DataFrame) -> DataFrame:
        rows = chunks
        for r in replies:
            rows = rows.union(r)
        return rows.repartition(n, "chunk").sortWithinPartitions("chunk", "part")

    def as_batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "chunk", "part", "data"]
        )

    def first_round(c: Chunk) -> Iterator[pa.RecordBatch]:
        for number, piece in c.pieces():
            yield as_batch(list(blobs(c.number, number, piece.classes, one_buckets)))

    def second_round(c: Chunk) -> Iterator[pa.RecordBatch]:
        for number, piece in c.pieces():
            _, single = piece.verdicts(c.coded(1, number, one_buckets))
            if single.any():
                yield as_batch(list(blobs(c.number, number, piece.windows(single)[2], two_buckets)))

    def last_round(c: Chunk) -> Iterator[pa.RecordBatch]:
        yield result(c, one_buckets, two_buckets, carry, keep)

    def over(rows: DataFrame, use, schema: str) -> DataFrame:
        return rows.mapInArrow(lambda batches: gathered(batches, length, q, chunk, use), schema)

    # Two of length - q + 2 places are chosen on average; an open class has a window for each place at most.
    one_buckets = buckets_for(chunks, 2 / (length - q + 2))
    one = written(asked(over(chunks, first_round, BLOBS), 1, n), "repeats-one")
    two_buckets = buckets_for(one, length - q + 1)
    two = asked(over(with_replies(one), second_round, BLOBS), 2, n)
    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start: long, end: long>>" + (", kept string" if keep else "")
    )
    for i, c in enumerate(carry):
        schema += f", carried_{i} {docs.schema[c].dataType.simpleString()}"
    found = over(with_replies(one, two), last_round, schema)
    if not carry:
        return found
    carried = F.struct(*(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)))
    return found.withColumn("carried", carried).drop(*(f"carried_{i}" for i in range(len(carry))))


def result(c: Chunk, one_buckets: int, two_buckets: int, carry: list[str], keep: bool) -> pa.RecordBatch:
    size = len(c.text)
    gone = np.zeros(size, dtype=bool)
    for number, piece in c.pieces():
        found = piece.entries
        smaller, single = piece.verdicts(c.coded(1, number, one_buckets))
        change = np.zeros(piece.size + 1, dtype=np.int32)
        np.add.at(change, found.low[smaller], 1)
        np.add.at(change, found.high[smaller] + c.length, -1)
        codes = c.coded(2, number, two_buckets)
        if len(codes):
            starts, owner, of = piece.windows(single)
            hit = starts[(codes[of.of_entry] == 1) | (owner > of.least[of.of_entry])]
            np.add.at(change, hit, 1)
            np.add.at(change, hit + c.length, -1)
        gone[piece.start : piece.start + piece.size] |= np.cumsum(change[:-1]) > 0
    bounds = np.concatenate([[0], np.cumsum(c.sizes)]).astype(np.int64)
    # Runs end with their document, also where two of them touch.
    edge = np.zeros(size + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[False], gone])[: size + 1]
    after = np.concatenate([gone, [False]])
    opens = np.flatnonzero(after & (~before | edge))
    closes = np.flatnonzero(before & (~after | edge))
    first = np.searchsorted(opens, bounds)
    hashes, kepts, spans, removed_bytes = [], [], [], []
    for d, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        mine = [(s - a, e - a) for s, e in zip(opens[first[d] : first[d + 1]].tolist(), closes[first[d] : first[d + 1]].tolist())]
        at, rest = 0, []
        for s, e in mine:
            rest.append(c.text[a + at : a + s])
            at = e
        rest.append(c.text[a + at : b])
        left = b"".join(rest)
        hashes.append(hashlib.sha256(left).hexdigest())
        spans.append([{"start": s, "end": e} for s, e in mine])
        removed_bytes.append(sum(e - s for s, e in mine))
        if keep:
            kepts.append(left.decode("utf-8", "ignore"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    arrays = [
        c.meta["doc_id"].combine_chunks(), pa.array(c.sizes, pa.int64()),
        pa.array(removed_bytes, pa.int64()), pa.array(np.diff(first), pa.int64()),
        pa.array(hashes, pa.string()), pa.array(spans, kind),
    ]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    if keep:
        arrays.append(pa.array(kepts, pa.string()))
        names.append("kept")
    for i in range(len(carry)):
        arrays.append(c.meta[f"carried_{i}"].combine_chunks())
        names.append(f"carried_{i}")
    return pa.RecordBatch.from_arrays(arrays, names=names)
