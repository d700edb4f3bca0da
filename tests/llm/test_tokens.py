import random

import numpy as np
import public_tokenizers
import pytest

from reddwatch.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "a", "it's  a\n\n test<|endoftext|> of<|endo", "été où 漢字かな 🙂🙂 ñandú", "x" * 900, " " * 700,
    "".join(chr(c) for c in range(32, 700)), "don't 'll 's " * 60,
]


def whole(text):
    return tokens.load(PATH).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("chunk,overlap", [(40, 4), (64, 30), (200, 50)])
def test_spliced_ids_are_the_ids_of_the_whole_text(chunk, overlap):
    rng = random.Random(chunk)
    made = ["".join(rng.choice(["a", " b", "  ", "\n", "é", "1", "!?", " the", "'s", "🙂", "<|endoftext|>"])
                    for _ in range(500)) for _ in range(20)]
    for text in TEXTS + made:
        assert tokens.chunked_ids(tokens.load(PATH), text, chunk, overlap) == whole(text)


def test_counts_with_nulls_repeats_and_clashing_names(spark, make):
    rows = [(1, None, 7), (2, "a b c", 7), (2, "a b c", 8), (None, "é" * 5000, 1)]
    docs = make(rows, "doc_id long, text string, n_tokens int")
    found = sorted(map(tuple, tokens.token_counts(docs, PATH, 2, chunk=100, overlap=9).collect()), key=str)
    n = len(whole("é" * 5000))
    assert found == sorted([(1, 0, 0, False), (2, 5, 3, True), (2, 5, 3, True), (None, 10000, n, n > 2)], key=str)
    assert tokens.token_counts(docs.limit(0), PATH, 2).count() == 0


def test_sentencepiece_models_are_counted_too(make):
    docs = make([(1, "a few words"), (2, None)], "doc_id long, text string")
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, path, 5).collect()}
    assert found == {1: len(tokens.load(path).encode("a few words")), 2: 0}


def test_words_are_those_of_the_library_for_every_character():
    encoder = tokens.Encoder(PATH)
    for first in range(0, 0x110000, 0x800):
        if 0xD800 <= first < 0xE000:
            continue
        chars = [chr(c) for c in range(first, first + 0x800) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c}{c}1 " for c in chars)
        assert encoder.fast is not None
        assert encoder.encode(text) == encoder.raw(whole(text)), hex(first)


def test_ids_are_those_of_the_library_for_made_up_words():
    encoder = tokens.Encoder(PATH)
    rng = random.Random(11)
    for _ in range(300):
        text = "".join(rng.choice("aeiounrstlchgTHE    ''!,.\n\t019éßñ漢🙂\u0301") for _ in range(rng.randint(0, 400)))
        assert encoder.encode(text) == encoder.raw(whole(text))


def test_other_vocabularies_are_left_to_the_library():
    assert tokens.same_by_rank(tokens.load(public_tokenizers.path("word_bpe_49k.json"))) is None


def brute(at, cost, size):
    best = {0: 0}
    for k in range(1, len(at)):
        options = []
        for i in range(k):
            n = int(at[k] - at[i])
            if n <= size:
                pad = 0 if n & (n - 1) == 0 else size - n
                options.append(best[i] + pad + int(cost[k]) + packing.SEQUENCE)
        best[k] = min(options)
    return best[len(at) - 1]


def test_the_plan_has_the_least_cost():
    rng = np.random.default_rng(5)
    for size in (16, 64):
        for _ in range(30):
            at = np.concatenate([[0], np.cumsum(rng.integers(1, 12, rng.integers(1, 60)))])
            cost = rng.integers(0, 9, len(at))
            path = packing.best_cuts(at, cost, size)
            total = 0
            for i, k in zip(path, path[1:]):
                n = int(at[k] - at[i])
                assert n <= size
                total += (0 if n & (n - 1) == 0 else size - n) + int(cost[k]) + packing.SEQUENCE
            assert total == brute(at, cost, size)


def check_pieces(rows, texts, size):
    import zlib

    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = whole(text or "") + [0]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            piece = np.array(ids[at : at + r.length], dtype="<u4")
            assert r.ids_crc32 == zlib.crc32(piece.tobytes())
            at += r.length
        assert at == len(ids)
    padding = held = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        held += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / (padding + held)


@pytest.mark.parametrize("block", [300, 1_000_000])
def test_every_id_is_in_one_piece_and_padding_is_small(make, block):
    rng = random.Random(1)
    texts = {i: " ".join(rng.choice(["word", "stone.", "runs", "it's", "Ñandú!"]) for _ in range(rng.randint(0, 700)))
             for i in range(60)}
    texts |= {60: None, 61: "", 62: "x" * 4000, 63: "a<|endoftext|>b"}
    docs = make([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, sequence_id int").coalesce(2)
    rows = packing.packed(docs, PATH, 128, block=block).collect()
    assert check_pieces(rows, texts, 128) < 0.05


def test_packing_nulls_repeats_and_nothing(make):
    docs = make([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string").coalesce(1)
    rows = packing.packed(docs, PATH, 8).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 1), (True, 2), (True, 2)]
    assert packing.packed(docs.limit(0), PATH, 8).count() == 0


def test_packing_of_the_whole_table(spark):
    from reddwatch.llm.queries import op3_packing

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check_pieces(op3_packing(spark, sf_dir).collect(), texts, 1024) < 0.01
