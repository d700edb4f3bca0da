import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from reddwatch.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)

ODD = [
    "", " ", "  ", "   ", "a", " a", "a ", "  a  b   ", "▁", "▁▁a ▁b", "a▁b", "\n", "a\n\nb\t c\r\n", "\x00a \x01",
    "<s> x </s> <unk> <0x0A>", "<0xE2><0x96><0x81>", "�", "⁇", "　Ａ ﬁ ﬂ", "日本語 中文字 한국어", "👩‍👩‍👧 🎉🎉", "é é", "​ ﻿ x",
    "don't 123 456.78 http://a.b/c?d=e", "x" * 3000, "ab " * 2000, " " * 70, "ß" * 100, "\U0010ffff ",
]


def slow(rows):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for doc_id, text in rows:
        ids = MODEL.encode(text or "")
        out.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(MODEL.decode(ids))))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    letters = ["a", "b", "c", " ", "  ", "é", "\n", "日", "th", "ing ", "▁", "😀", "1"]
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for i in range(n)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)]
    rows += [(None, "of no id"), (None, None), (5, None), rows[3], rows[3], (-1, "the " * 50)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk,bucket", [(pieces.CHUNK, pieces.BUCKET), (300, 40), (1, 5)])
def test_ids_and_texts_are_the_librarys(make, chunk, bucket):
    rows = corpus(chunk)
    docs = make([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, chunk int, words string").repartition(3)
    found = pieces.encoded(docs, PATH, chunk=chunk, bucket=bucket)
    assert sorted(map(tuple, found.collect()), key=str) == slow(rows)


def test_whole_ids_and_texts_round_trip(make):
    rows = [(i, t) for i, t in enumerate(ODD)]
    found = pieces.encoded(make(rows, "doc_id long, text string"), PATH, whole=True).collect()
    for r in found:
        assert r.ids == MODEL.encode(ODD[r.doc_id]) and r.decoded == MODEL.decode(r.ids)


def test_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, pieces.encoded(docs, PATH, from_files=True).collect()), key=str) == slow(rows)


def test_no_rows(make):
    assert pieces.encoded(make([], "doc_id long, text string"), PATH).count() == 0


def test_a_chunk_has_each_word_once(make):
    rows = [(i, "same words again " * 20) for i in range(30)]
    blobs = pieces.dealt(make(rows, "doc_id long, text string").repartition(2), PATH, 500, 4).collect()
    for row in blobs:
        words = pieces.unstrings(row.data)
        assert len(words) == len(set(words)) and set(words) <= {"▁same", "▁words", "▁again", "▁"}


def test_other_vocabularies_take_texts_whole(monkeypatch):
    assert pieces.cuts_at_markers(PATH)
    monkeypatch.setitem(pieces._by_words, PATH, False)
    assert pieces.marked_words("a b", pieces.cuts_at_markers(PATH)) == ["a b"]


def test_changed_documents_are_found_out():
    chunk = object.__new__(pieces.Chunk)
    chunk.order, chunk.lengths = [0, 1], []
    with pytest.raises(RuntimeError):
        list(chunk.documents())
