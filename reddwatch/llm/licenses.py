"""License notices in texts: winnowed fingerprints pick candidates, banded alignment measures them.

Fingerprints of a template are word K-grams, of each window of WINDOW of them the one with the least hash value. K,
WINDOW and the number of fingerprints that a text must share in a stretch a little longer than the template follow
from the template's length and the coverage asked for, so that no match is overlooked (`settings`). Templates
are looked up in an inverted index by the text's fingerprints; where enough of them meet, all places at which the
template may begin are aligned in a band. What covers at least `share` of the template is reported with its span.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import documents

# The most words in a fingerprint and K-grams in a window; `settings` takes fewer where these could overlook a match.
K, WINDOW = 3, 3
# In templates of fewer words than LONG each word is a fingerprint; shorter ones than LEAST mean too little.
LONG, LEAST = 60, 4
SHARE = 0.8
# Places of a template that are aligned at once.
PLACES = 8
WORDS = 200_000
_WORD = re.compile(r"\w+")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*(\(?[\w.+-]+\)?(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(?[\w.+-]+\)?)*)", re.I)

_GNU_FIRST = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} License "
    "as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later "
    "version."
)
_GNU_REST = (
    " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} License for more "
    "details. You should have received a copy of the GNU {0} License along with this program. If not, see "
    "https://www.gnu.org/licenses/."
)
_GNU = {
    "gpl-2.0": ("General Public", "2"), "gpl-3.0": ("General Public", "3"), "lgpl-2.1": ("Lesser General Public", "2.1"),
    "lgpl-3.0": ("Lesser General Public", "3"), "agpl-3.0": ("Affero General Public", "3"),
}
# Notices as licenses prescribe or recommend them, or as projects commonly write them. Those
# ending in -line, -permission, -redistribution, -first and gpl-header are phrases or beginnings only.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "bsd-line": "Released under the BSD License.",
    "cc-by-nd-4.0-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-nd-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-nc-sa-4.0-line": "Licensed under CC BY-NC-SA 4.0.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-only-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation."
    ),
    "isc-line": "Released under the ISC License.",
    "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "mpl-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    **{f"{k}-first": _GNU_FIRST.format(*v) for k, v in _GNU.items() if k != "gpl-3.0"},
    **{f"{k}-header": (_GNU_FIRST + _GNU_REST).format(*v) for k, v in _GNU.items()},
    # Whole licenses, as the files of these names hold them.
    **{
        file.name.removesuffix(".txt"): file.read_text(encoding="utf-8")
        for file in sorted(files("reddwatch.llm").joinpath("license_texts").iterdir(), key=lambda file: file.name)
        if file.name.endswith(".txt")
    },
}

MATCHES = (
    "doc_id long, template string, n_words int, n_matched int, coverage double, start long, end long"
)


def split(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words in lower case and where they are in the text."""
    found = list(_WORD.finditer(text))
    return [m.group().lower() for m in found], [m.span() for m in found]


class Numbers(dict):
    """Hash values of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS:
            self.clear()
        value = zlib.crc32(word.encode()) | zlib.adler32(word.encode()) << 32
        self[word] = value
        return value


def winnowed(numbers: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hash values and places of the k-grams that are least in a window, the rightmost of equals."""
    n = len(numbers) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            grams = (grams ^ numbers[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
    if window == 1:
        return grams, np.arange(n)
    windows = np.lib.stride_tricks.sliding_window_view(grams, min(window, n))
    last = windows.shape[1] - 1
    places = np.unique(np.arange(len(windows)) + last - np.argmin(windows[:, ::-1], axis=1))
    return grams[places], places


def needed(n: int, share: float) -> int:
    return math.ceil(share * n - 1e-9)


def band_of(n: int, share: float = SHARE) -> int:
    """How many words more a match may span than the template, and how far its words may be displaced."""
    return max(2, n // 5, n - needed(n, share))


def step_of(n: int, share: float) -> int:
    """Every which place a template is aligned at, in a band that is wider by as much less one."""
    return max(1, band_of(n, share) // 8)


def settings(n: int, share: float) -> tuple[int, int, int]:
    """K, window and least number of shared fingerprints for a template of n words.

    A match that spans at most the band more than the template has at least `needed` words of it in order. The other
    words on both sides cut them into `runs` runs at most, so one of them has `longest` words, and a run of L words
    shares a fingerprint for each window in it, (L - K + 1) // window. In short templates a match may have all its words
    apart, so each word is a fingerprint.
    """
    need, band = needed(n, share), band_of(n, share)
    if n < LONG:
        return 1, 1, need
    runs = 1 + 2 * (n - need) + band
    longest = -(-need // runs)
    k = min(K, longest // 2 + 1)
    window = min(WINDOW, longest - k + 1)
    return k, window, max(1, (need - runs * (k + window - 2)) // window)


class Postings:
    """Inverted index of the fingerprints of those templates that have the same K and window."""

    def __init__(self, prints: dict[str, np.ndarray], least: dict[str, int]):
        self.names = list(prints)
        self.least = np.array([least[name] for name in self.names])
        self.keys = np.unique(np.concatenate(list(prints.values())))
        # How often each fingerprint is in each template.
        self.times = np.zeros((len(self.keys), len(self.names)), dtype=np.int32)
        for t, values in enumerate(prints.values()):
            np.add.at(self.times[:, t], np.searchsorted(self.keys, values), 1)

    def shared(self, values: np.ndarray, places: np.ndarray) -> Iterator[tuple[str, int, np.ndarray]]:
        """Templates that have enough of these fingerprints, with the number that is enough and the places of theirs."""
        slots = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        known = self.keys[slots] == values
        slots, places = slots[known], places[known]
        enough = self.times[np.unique(slots)].sum(axis=0) >= self.least
        for t in np.flatnonzero(enough & (self.least <= len(slots))).tolist():
            at = places[self.times[slots, t] > 0]
            if len(at) >= self.least[t]:
                yield self.names[t], int(self.least[t]), at


class Index:
    """Templates by fingerprint, for matches that cover at least `share` of one."""

    def __init__(self, templates: dict[str, str], spdx: bool = False, share: float = SHARE):
        self.spdx, self.share = spdx, share
        self.numbers = Numbers()
        self.words = {name: split(text)[0] for name, text in templates.items()}
        if short := [name for name, words in self.words.items() if len(words) < LEAST]:
            raise ValueError(f"templates need {LEAST} words: {short}")
        self.row = {w: i for i, w in enumerate(sorted({w for words in self.words.values() for w in words}))}
        self.rows = {name: np.array([self.row[w] for w in words]) for name, words in self.words.items()}
        self.known = {w: self.numbers[w] for w in self.row}
        self.bits: dict[str, dict[str, int]] = {}
        prints: dict[tuple[int, int], dict[str, np.ndarray]] = defaultdict(dict)
        least: dict[str, int] = {}
        for name, words in self.words.items():
            places: dict[str, int] = defaultdict(int)
            for i, w in enumerate(words):
                places[w] |= 1 << i
            self.bits[name] = dict(places)
            k, window, least[name] = settings(len(words), share)
            prints[k, window][name] = self.fingerprints(words, k, window)[0]
        self.postings = {kind: Postings(found, least) for kind, found in prints.items()}

    def fingerprints(self, words: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        return winnowed(self.hashed(words), k, window)

    def hashed(self, words: list[str]) -> np.ndarray:
        number = self.numbers
        return np.fromiter((number[w] for w in words), dtype=np.uint64, count=len(words))

    def candidates(self, words: list[str]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Templates, with the first and last of neighbouring places in the words where they may begin."""
        # Other words may all have one value, as no shared fingerprint has any of them.
        numbers = np.fromiter((self.known.get(w, 0) for w in words), dtype=np.uint64, count=len(words))
        for (k, window), postings in self.postings.items():
            for name, least, at in postings.shared(*winnowed(numbers, k, window)):
                n = len(self.words[name])
                band = band_of(n, self.share) + step_of(n, self.share) - 1
                width = n + 2 * band
                first, last = at[: len(at) - least + 1], at[least - 1 :] + k
                near = last - first <= width
                # Stretches from low to high on have that many of the fingerprints; a template begins a band behind.
                low, high = (last[near] - width + band).tolist(), (first[near] + band).tolist()
                ranges: list[tuple[int, int]] = []
                for a, b in zip(low, high):
                    if ranges and a <= ranges[-1][1] + 1:
                        ranges[-1] = ranges[-1][0], max(b, ranges[-1][1])
                    else:
                        ranges.append((a, b))
                if ranges:
                    yield name, ranges


def subsequence(bits: dict[str, int], n: int, words: Iterable[str]) -> int:
    """How many words the longest common subsequence with the template has; no alignment has more."""
    full = (1 << n) - 1
    left = full
    for word in words:
        if mask := bits.get(word):
            met = left & mask
            left = ((left + met) | (left - met)) & full
    return n - left.bit_count()


# A state of an alignment is a number: its matched words, then how short its span is, then how early it begins.
_FIELD = 21
_MOST = (1 << _FIELD) - 1


def alignments(template: np.ndarray, rows: np.ndarray, starts: np.ndarray, band: int) -> np.ndarray:
    """Matched words, and first and last + 1 word of the best alignment around each start.

    Word i of the template may meet word start + i + d only with d from -band to band. Words skipped on either
    side cost nothing; of equal alignments one with the shortest span is taken, of those the first.
    """
    n, width = len(template), 2 * band + 1
    if n + width > _MOST:
        raise ValueError("the template is too long")
    at = starts[:, None] - band + np.arange(n + width - 1)
    around = np.where((at >= 0) & (at < len(rows)), rows[np.clip(at, 0, len(rows) - 1)], -1)
    best = np.zeros((len(starts), width), dtype=np.int64)
    for i in range(n):
        fresh = best.copy()
        line, x = np.nonzero(around[:, i : i + width] == template[i])
        if len(line):
            state, place = best[line, x], x + i
            first = np.where(state > 0, _MOST - (state & _MOST), place)
            matched = (state >> 2 * _FIELD) + 1
            fresh[line, x] = matched << 2 * _FIELD | (_MOST - (place + 1 - first)) << _FIELD | (_MOST - first)
        # A word of the template is left out, or any number of words of the text are.
        np.maximum(fresh[:, :-1], best[:, 1:], out=fresh[:, :-1])
        best = np.maximum.accumulate(fresh, axis=1)
    state = best[:, -1]
    span, first = _MOST - (state >> _FIELD & _MOST), _MOST - (state & _MOST) + starts - band
    found = np.stack([state >> 2 * _FIELD, first, first + span], axis=1)
    return np.where(state[:, None] > 0, found, 0)


def aligned(template: list[str], words: list[str], start: int, band: int) -> tuple[int, int, int]:
    """`alignments` of words around one start."""
    row = {w: i for i, w in enumerate(dict.fromkeys(template))}
    rows = np.array([row.get(w, -1) for w in words] or [-1])
    return tuple(alignments(np.array([row[w] for w in template]), rows, np.array([start]), band)[0].tolist())


def scan(text: str, index: Index, share: float) -> list[tuple[str, int, int, int, int]]:
    """template, its words, matched words, start and end (characters) of each match. None overlaps another of
    the same template, and none lies by half or more in a better match of another template."""
    if share < index.share:
        raise ValueError(f"the index is one for matches of at least {index.share}")
    words, spans = split(text)
    found = []
    rows = None
    for name, ranges in index.candidates(words):
        n = len(index.words[name])
        need, step = needed(n, share), step_of(n, index.share)
        band = band_of(n, index.share) + step - 1
        tried: set[tuple[int, int, int]] = set()
        for low, high in ranges:
            for a in range(low, high + 1, PLACES * step):
                starts = np.arange(a, min(high + 1, a + PLACES * step), step)
                there = words[max(0, a - band) : max(0, int(starts[-1]) + n + band)]
                if subsequence(index.bits[name], n, there) < need:
                    continue
                if rows is None:
                    rows = np.fromiter((index.row.get(w, -1) for w in words), dtype=np.int64, count=len(words))
                met = alignments(index.rows[name], rows, starts, band)
                tried.update(map(tuple, met[met[:, 0] >= max(need, 1)].tolist()))
        taken: list[tuple[int, int, int]] = []
        for matched, first, last in sorted(tried, key=lambda t: (-t[0], t[2] - t[1], t[1])):
            if all(last <= a or b <= first for _, a, b in taken):
                taken.append((matched, first, last))
        found += [(name, n, m, spans[first][0], spans[last - 1][1]) for m, first, last in taken]
    # A notice that lies by half or more in one that matches more words, or as many of fewer, is not one of its own.
    better = lambda g, f: (g[2], g[2] / g[1]) > (f[2], f[2] / f[1])
    whole = [
        f for f in found
        if not any(
            g[0] != f[0] and better(g, f) and 2 * (min(f[4], g[4]) - max(f[3], g[3])) >= f[4] - f[3] for g in found
        )
    ]
    if index.spdx:
        for m in _SPDX.finditer(text):
            n = len(_WORD.findall(m.group()))
            whole.append((f"spdx:{m.group(1)}", n, n, *m.span()))
    return sorted(whole, key=lambda f: (f[3], f[4], f[0]))


@lru_cache(maxsize=1)
def common(share: float = SHARE) -> Index:
    """The index of TEMPLATES, made once for each Python process."""
    return Index(TEMPLATES, True, share)


def matches(
    docs: DataFrame, templates: dict[str, str] | None = None, share: float = SHARE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, template, n_words, n_matched, coverage, start, end (in characters) of each template's matches.

    `templates` are a parameter that each task holds, names to texts of at least LEAST words; the default are
    TEMPLATES and, under the name spdx: and what it says, each SPDX-License-Identifier. Words of a match are displaced
    by at most the band: a fifth of the template's words, or as many as it may lack, two at least. All of these are
    found for templates of fewer words than LONG; of LONG ones, all that span at most the band more than
    the template, and others where they share enough fingerprints. Null texts count as empty,
    texts without a match give no row, null ids stay null, repeated rows are reported each, an empty table gives
    no rows, further columns are ignored.
    """
    chosen = None if templates is None else dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = common(share) if chosen is None else Index(chosen, share=share)
        names = [c.split()[0] for c in MATCHES.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = [
                (doc_id, name, n, matched, matched / n, start, end)
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                for name, n, matched, start, end in scan(text, index, share)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )

    return documents(docs, id_col, text_col).mapInArrow(run, MATCHES)
