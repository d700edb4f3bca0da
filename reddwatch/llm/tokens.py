"""Token counts of whole texts; very long ones are encoded in overlapping chunks and spliced."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reddwatch.llm.common import documents

# Texts beyond CHUNK characters are encoded in pieces of that length that share OVERLAP characters.
CHUNK = 32_768
OVERLAP = 256
# Fixed value: how the vocabulary's byte-level pre-tokenizer splits words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict[str, object] = {}


def load(path: str):
    """The library's object for a vocabulary file, once for each worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if path.endswith(".model"):
            import sentencepiece

            _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _loaded[path] = tokenizer
    return _loaded[path]


def word_starts(encoding) -> dict[int, int]:
    """Where words of the pre-tokenizer begin: character to number of the token that begins there."""
    words, offsets = encoding.word_ids, encoding.offsets
    return {
        offsets[i][0]: i
        for i in range(len(words))
        if i == 0 or words[i] is None or words[i] != words[i - 1]
    }


def chunked_ids(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of the whole text, from encodings of overlapping chunks.

    The left chunk is right as long as what it sees equals the text, so a word start of it that lies
    further from its cut end than any special string and one character is a word start of the whole
    text. The words of this kind of pre-tokenizer depend on what follows them only, so from a start
    that both chunks have on, the right chunk is right too. Where the overlap has no common start, it
    is widened to twice its size, at worst until the left chunk holds the rest of the text.
    """
    special = tokenizer.get_added_tokens_decoder().values()
    guard = 2 + max((len(s.content) for s in special), default=0)
    encode = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False)
    at, skip, ids, wide = 0, 0, [], max(overlap, guard + 1)
    left = encode(0, chunk)
    while at + chunk < len(text):
        end = at + chunk
        begin = max(end - wide, at + skip + 1)
        right = encode(begin, begin + chunk) if begin < end - guard else None
        mine = word_starts(left)
        common = None
        if right is not None:
            theirs = word_starts(right)
            common = next(
                (
                    (mine[p], theirs[p - (begin - at)], p)
                    for p in sorted(mine, reverse=True)
                    if p < chunk - guard and p > max(begin - at, skip) and p - (begin - at) in theirs
                ),
                None,
            )
        if common is None:
            if begin > at + skip + 1 and wide < chunk // 2:
                wide *= 2
            else:  # a word as long as the chunk: the chunk grows over it
                chunk, wide = chunk * 2, max(overlap, guard + 1)
                left = encode(at, at + chunk)
            continue
        i, j, p = common
        first = word_starts(left)[skip] if skip else 0
        ids.extend(left.ids[first:i])
        left, skip, at, wide = right, p - (begin - at), begin, max(overlap, guard + 1)
    first = word_starts(left)[skip] if skip else 0
    ids.extend(left.ids[first:])
    return ids


def looks_ahead_only(tokenizer) -> bool:
    """Whether words depend on the text from their start on only: byte-level words, text unchanged."""
    return tokenizer.normalizer is None and type(tokenizer.pre_tokenizer).__name__ == "ByteLevel" \
        and not tokenizer.pre_tokenizer.add_prefix_space


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves,
    the others in their order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def same_by_rank(tokenizer):
    """An encoder over the vocabulary of the file that takes the pair with the least id first, or None.

    It gives the ids of the library, in a third of the time, if the file's merges are in the order of
    the ids they make, nothing else is done to words, and words are split by the byte-level rule.
    """
    import tiktoken

    model = json.loads(tokenizer.to_str())["model"]
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    if model.get("type") != "BPE" or any(model.get(k) for k in odd) or not looks_ahead_only(tokenizer):
        return None
    vocabulary, bytes_of = model["vocab"], byte_characters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in pairs]
    merged = set(made)
    used = {t: i for t, i in vocabulary.items() if i in merged or len(t) == 1}
    if made != sorted(merged) or any(c not in bytes_of for t in used for c in t):
        return None
    ranks = {bytes(bytes_of[c] for c in t): i for t, i in used.items()}
    return tiktoken.Encoding("by-rank", pat_str=WORD, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts as bytes of unsigned 32-bit little-endian numbers."""

    def __init__(self, path: str):
        self.model = load(path)
        self.special = [s.content for s in self.model.get_added_tokens_decoder().values()]
        self.fast = same_by_rank(self.model)
        self.ends: np.ndarray | None = None

    def raw(self, ids) -> bytes:
        return np.asarray(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return self.raw(self.model.encode(text, add_special_tokens=False).ids)
        return self.raw(self.fast.encode_to_numpy(text, disallowed_special=()))

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether a sentence may end after it: a stop or a line break ends its text."""
        if self.ends is None:
            size = self.model.get_vocab_size()
            self.ends = np.zeros(size, dtype=bool)
            for i in range(size):
                s = self.model.decode([i], skip_special_tokens=False)
                self.ends[i] = "\n" in s or s.rstrip().endswith((".", "!", "?"))
        return self.ends


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder for a vocabulary file, once for each worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def counts(texts: list[str], path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    model = load(path)
    if path.endswith(".model"):
        return [len(ids) for ids in model.encode(texts, num_threads=1)] if texts else []
    encoder, splice = encoder_of(path), looks_ahead_only(model)
    return [
        len(chunked_ids(model, text, chunk, overlap)) if splice and len(text) > chunk else encoder.count(text)
        for text in texts
    ]


def token_counts(
    docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """Per row doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: no bytes, no tokens. Null ids stay null, repeated rows stay repeated,
    an empty table gives no rows, further columns are ignored whatever their names. The vocabulary is a
    file that every executor has at `path`.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = counts(texts, path, chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(found, pa.int64()),
                    pa.array([n > limit for n in found], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return documents(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
