"""SentencePiece ids and decoded texts of whole documents, over a table of distinct chunks.

Where no piece of the vocabulary has a white space marker behind another character, merges never leave a
marked word (a run of markers and what follows up to the next one), so a text's ids are those of its marked
words one after another. Three steps use that:

- Documents are gathered into chunks of some MB, and the distinct marked words of all chunks meet in buckets, where
  each distinct one is segmented once by the library.
- The documents are read again; a chunk now holds its texts as numbers of its words.
- The words' ids go back to the chunks and are joined by position.

A frequent word enters its bucket once for each chunk and not for each place. The number of buckets follows
the bytes of the texts. With vocabularies or normalizers that break the rule a whole text is one word.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import documents, pack, partitions, squeeze, unsqueeze, written
from reddwatch.llm.tokens import load

MARKER = "▁"
WORD = re.compile(f"{MARKER}+[^{MARKER}]*")
# Characters of text in a chunk; a longer document is a chunk of its own.
CHUNK = 8 << 20
# Bytes of text for each bucket; its distinct words are a small part of that.
BUCKET = 64 << 20

BLOBS = "bucket long, chunk long, data binary"
ROWS = "chunk long, part long, data binary"
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_by_words: dict[str, bool] = {}


def cuts_at_markers(path: str) -> bool:
    """Whether marked words of this vocabulary can be segmented one by one: no piece has a marker behind
    another character, a marker is a piece, and the normalizer only puts markers for spaces and one in front."""
    if path not in _by_words:
        model = load(path)
        pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        sample = "".join(chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
        sample = f"  {sample}  a  "
        _by_words[path] = (
            all(MARKER not in piece.lstrip(MARKER) for piece in pieces)
            and model.id_to_piece(model.piece_to_id(MARKER)) == MARKER
            and model.normalize(sample) == MARKER + sample.replace(" ", MARKER)
        )
    return _by_words[path]


def marked_words(text: str, by_words: bool) -> list[str]:
    if not text:
        return []
    return WORD.findall(MARKER + text.replace(" ", MARKER)) if by_words else [text]


def plain(word: str, by_words: bool) -> str:
    """What the library is given for a word, which puts the first marker in front itself."""
    return word[1:].replace(MARKER, " ") if by_words else word


def strings(values: list[str]) -> bytes:
    data = [v.encode() for v in values]
    sizes = np.fromiter(map(len, data), dtype="<u4", count=len(data))
    return squeeze(np.array([len(data)], dtype="<i8").tobytes() + pack(sizes) + b"".join(data))


def unstrings(data: bytes) -> list[str]:
    data = unsqueeze(data)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 8), dtype=np.int64) + 8 + 4 * n
    starts = [8 + 4 * n, *ends[:-1].tolist()]
    return [data[a:b].decode() for a, b in zip(starts, ends.tolist())]


def bucket_numbers(words: list[str], buckets: int) -> np.ndarray:
    """The bucket of each word, by a checksum that is the same on all machines."""
    return np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), dtype="<u4", count=len(words))


def gathered(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[int, list[int | None], list[str]]]:
    """Chunks of documents: number, ids, texts. Reading the same rows again gives the same chunks."""
    number = TaskContext.get().partitionId() << 33
    ids: list[int | None] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            if ids and size + len(text) > chunk:
                yield number, ids, texts
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if ids:
        yield number, ids, texts


def dealt(docs: DataFrame, path: str, chunk: int, buckets: int) -> DataFrame:
    """The distinct words of each chunk, in the order of their first places, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_words = cuts_at_markers(path)
        for number, _, texts in gathered(batches, chunk):
            known: dict[str, None] = {}
            for text in texts:
                known.update(dict.fromkeys(marked_words(text, by_words)))
            words = list(known)
            bucket = bucket_numbers(words, buckets)
            order = np.argsort(bucket, kind="stable")
            groups = [g for g in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(g)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[g[0]]) for g in groups], pa.int64()), pa.array([number] * len(groups), pa.int64()),
                 pa.array([strings([words[i] for i in g.tolist()]) for g in groups], pa.binary())],
                names=["bucket", "chunk", "data"],
            )

    return docs.mapInArrow(run, BLOBS)


def segmented(blobs: DataFrame, path: str) -> DataFrame:
    """Replies to blobs: each distinct word of a bucket is segmented once. `data` has the numbers of ids of
    the blob's words and then the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, by_words = load(path), cuts_at_markers(path)
        wide = "<u2" if model.get_piece_size() <= 1 << 16 else "<u4"
        bucket = None
        table: dict[str, list[int]] = {}

        def learn(words: list[str]) -> None:
            new = [w for w in words if w not in table]
            found = model.encode([plain(w, by_words) for w in new], num_threads=1)
            table.update(zip(new, found))
            if by_words and MARKER in table:  # a marker alone: the library puts none in front of nothing
                table[MARKER] = [model.piece_to_id(MARKER)]

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket = row["bucket"]
                    table.clear()
                words = unstrings(row["data"])
                learn(words)
                found = [table[w] for w in words]
                counts = np.fromiter(map(len, found), dtype="<u4", count=len(found))
                ids = np.fromiter((i for f in found for i in f), dtype=wide, count=int(counts.sum()))
                data = np.array([len(found), int(wide[2])], dtype="<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]], pa.int64()), pa.array([bucket + 1], pa.int64()),
                     pa.array([squeeze(pack(data) + pack(counts) + pack(ids))], pa.binary())],
                    names=["chunk", "part", "data"],
                )

    return blobs.mapInArrow(run, ROWS)


def planes(numbers: np.ndarray) -> bytes:
    """4-byte numbers as their first bytes, then their second ones and so on, which compress better."""
    return pack(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def unplanes(data: bytes, at: int) -> np.ndarray:
    found = np.frombuffer(data, np.uint8, -1, at).reshape(4, -1)
    return np.ascontiguousarray(found.T).view("<u4").ravel()


def numbered(docs: DataFrame, path: str, chunk: int, buckets: int) -> DataFrame:
    """Chunks with their documents' ids, numbers of words, each word's bucket, and the words' numbers by position;
    frequent words have small numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_words = cuts_at_markers(path)
        for number, ids, texts in gathered(batches, chunk):
            known: dict[str, int] = {}
            places: list[int] = []
            counts = []
            for text in texts:
                words = marked_words(text, by_words)
                counts.append(len(words))
                places.extend([known.setdefault(w, len(known)) for w in words])
            place = np.array(places, dtype=np.int64)
            often = np.argsort(-np.bincount(place, minlength=len(known)), kind="stable")
            rank = np.empty(len(known), dtype=np.int64)
            rank[often] = np.arange(len(known))
            # Words of a bucket lie in the order of their first places, as in its blob.
            bucket = bucket_numbers(list(known), buckets)
            order = rank[np.argsort(bucket, kind="stable")]
            some = np.array([i is not None for i in ids], dtype=np.uint8)
            data = b"".join([
                np.array([len(ids), len(known)], dtype="<i8").tobytes(), pack(np.array([i or 0 for i in ids], dtype="<i8")),
                pack(np.array(counts, dtype="<i8")), pack(order.astype("<u4")), pack(some), planes(rank[place]),
            ])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([0], pa.int64()), pa.array([squeeze(data)], pa.binary())],
                names=["chunk", "part", "data"],
            )

    return docs.mapInArrow(run, ROWS)


class Chunk:
    """A chunk that takes in the replies to its words, in the order of their buckets."""

    def __init__(self, data: bytes):
        data = unsqueeze(data)
        n, words = (int(x) for x in np.frombuffer(data, "<i8", 2))
        ids = np.frombuffer(data, "<i8", n, 16).tolist()
        self.counts = np.frombuffer(data, "<i8", n, 16 + 8 * n)
        self.order = np.frombuffer(data, "<u4", words, 16 + 16 * n)
        at = 16 + 16 * n + 4 * words
        self.ids = [i if s else None for i, s in zip(ids, np.frombuffer(data, np.uint8, n, at))]
        self.places = unplanes(data, at + n)
        self.lengths: list[np.ndarray] = []
        self.found: list[np.ndarray] = []

    def take(self, data: bytes) -> None:
        data = unsqueeze(data)
        n, width = (int(x) for x in np.frombuffer(data, "<i8", 2))
        self.lengths.append(np.frombuffer(data, "<u4", n, 16).astype(np.int64))
        self.found.append(np.frombuffer(data, f"<u{width}", -1, 16 + 4 * n).astype("<u4"))

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """doc_id and ids."""
        lengths = np.concatenate([np.zeros(0, dtype=np.int64), *self.lengths])
        if len(lengths) != len(self.order):
            raise RuntimeError("the documents have changed between two readings")
        flat = np.concatenate([np.zeros(0, dtype="<u4"), *self.found])
        begin = np.empty(len(lengths), dtype=np.int64)
        length = np.empty(len(lengths), dtype=np.int64)
        begin[self.order], length[self.order] = np.cumsum(lengths) - lengths, lengths
        ends = np.cumsum(self.counts)
        for doc_id, a, b in zip(self.ids, (ends - self.counts).tolist(), ends.tolist()):
            mine = self.places[a:b]
            n = length[mine]
            at = np.arange(n.sum()) + np.repeat(begin[mine] - (np.cumsum(n) - n), n)
            yield doc_id, flat[at]


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
    bucket: int = BUCKET, whole: bool = False, from_files: bool = False,
) -> DataFrame:
    """Per document doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 (of what
    the ids decode to), and with `whole` also `ids` as an array and `decoded`.

    A null or an empty text has no ids and decodes to nothing. Null ids stay null, repeated rows stay
    repeated, an empty table gives no rows, further columns are ignored whatever their names. A text is
    never cut; one longer than a chunk is a chunk of its own. The model is a file that every executor has at `path`.
    Documents are read twice and written first, unless `from_files` says that they are rows of files as they
    are, which come in the same order each time.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = documents(docs, id_col, text_col)
    if not from_files:
        rows = written(rows, "pieces-documents")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = max(n, -(-size // bucket))
    blobs = dealt(rows, path, chunk, buckets).repartition(n, "bucket").sortWithinPartitions("bucket")
    parts = numbered(rows, path, chunk, buckets).union(segmented(blobs, path))
    parts = parts.repartition(n, "chunk").sortWithinPartitions("chunk", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        names = list(map(str, range(model.get_piece_size())))
        held: Chunk | None = None

        def out() -> Iterator[pa.RecordBatch]:
            columns: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
            for doc_id, found in held.documents():
                ids = found.tolist()
                text = model.decode(ids)
                columns["doc_id"].append(doc_id)
                columns["n_tokens"].append(len(ids))
                columns["ids_sha256"].append(hashed(",".join([names[i] for i in ids])))
                columns["decoded_sha256"].append(hashed(text))
                if whole:
                    columns["ids"].append(ids)
                    columns["decoded"].append(text)
            kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.string())) for c, v in columns.items()})

        for batch in batches:
            for i in range(batch.num_rows):
                data = batch["data"][i].as_py()
                if batch["part"][i].as_py() == 0:
                    if held is not None:
                        yield from out()
                    held = None  # before the next one is built
                    held = Chunk(data)
                else:
                    held.take(data)
        if held is not None:
            yield from out()

    schema = RESULT + (", ids array<int>, decoded string" if whole else "")
    return parts.mapInArrow(run, schema)
