import hashlib
import random

import pytest

from reddwatch.llm import repeats


def slow(rows, length):
    first = {}
    big = 1 << 70
    data = [((text or "").encode(), big if doc_id is None else doc_id) for doc_id, text in rows]
    for text, doc_id in data:
        for i in range(len(text) - length + 1):
            key = text[i : i + length]
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), (text, order) in zip(rows, data):
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if first[text[i : i + length]] < order:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    letters = ["a", "b", "é", " "] if seed % 2 else list("abcdefghij klmnop ")
    passage = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 160))) for _ in range(12)]
    rows = []
    for i in range(50):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passage)
            if rng.random() < 0.5:
                a = rng.randrange(len(p))
                p = p[a : a + rng.randint(1, 120)]
            if rng.random() < 0.2:
                p = "".join(rng.choice(letters) for _ in range(40))
            parts.append(p)
        rows.append((i, "".join(parts)))
    rows += [(70, "a" * 300), (71, "a" * 60), (72, "a" * 49), (73, "ab" * 100), (74, None), (75, ""), rows[3], rows[3],
             (None, rows[4][1]), (None, rows[4][1] + "tail"), (None, "x" * 80), (-5, rows[9][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("length,q,chunk,bucket", [
    (50, 16, 300, 1 << 23), (50, 25, 1 << 20, 1 << 23), (20, 8, 1000, 200), (24, 6, 90, 2000), (50, 25, 70, 500),
])
def test_removed_bytes_are_those_of_brute_force(make, monkeypatch, seed, length, q, chunk, bucket):
    """Also with documents of many pieces, and many buckets."""
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    rows = corpus(seed)
    docs = make([(d, t, 1) for d, t in rows], "doc_id long, text string, n_spans int").repartition(3)
    found = repeats.removed(docs, length=length, q=q, chunk=chunk)
    mine = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, mine), key=str) == slow(rows, length)


def test_kept_texts_spans_and_carried_columns(make):
    line = "the same passage of more than fifty bytes, which é starts"
    docs = make([(1, line + " one", "a"), (2, "two " + line, None)], "doc_id long, text string, kept string")
    rows = {r.doc_id: r for r in repeats.removed(docs, carry=["kept"], keep=True).collect()}
    assert rows[1].kept == line + " one" and rows[1].spans == [] and rows[1].carried.kept == "a"
    assert rows[2].kept == "two " and rows[2].carried.kept is None
    assert [(s.start, s.end) for s in rows[2].spans] == [(4, 4 + len(line.encode()))]


def test_no_rows_and_wrong_lengths(make):
    docs = make([], "doc_id long, text string")
    assert repeats.removed(docs).count() == 0
    with pytest.raises(ValueError):
        repeats.removed(docs, length=50, q=5)


def test_a_document_of_many_pieces_takes_a_few_bytes_for_each_of_its_own():
    """Neither the entries nor the marks of more than one piece are in memory at a time."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    text = np.random.default_rng(1).integers(32, 127, 6 << 20, dtype=np.uint8).tobytes()
    sink = pa.BufferOutputStream()
    meta = pa.table({"doc_id": pa.array([1], pa.int64()), "size": pa.array([len(text)], pa.int64())})
    with pa.ipc.new_stream(sink, meta.schema) as writer:
        writer.write_table(meta)
    packed = repeats.squeeze(sink.getvalue().to_pybytes()), repeats.squeeze(text)
    tracemalloc.start()
    chunk = repeats.Chunk(0, *packed, 50, 25, 1 << 18)
    pieces = 0
    for number, piece in chunk.pieces():
        rows = list(repeats.blobs(0, number, piece.classes, 8))
        chunk.take(number * 8 + 1, 1, repeats.squeeze(bytes(len(piece.classes.first))))
        pieces += 1
    del rows, piece
    repeats.result(chunk, 8, 8, [], False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces == 24 and peak < 10 * len(text)
