import random

import pytest

from reddwatch.llm import licenses

WORDS = [f"filler{i}" for i in range(50)]


def best_alignment(template, words):
    """Longest common subsequence of the template and any part of the words, at the least span."""
    best = (0, 0, 0)
    n = len(template)
    for a in range(len(words)):
        row = [0] * (n + 1)
        for b in range(a, min(len(words), a + 2 * n)):
            new = [0] * (n + 1)
            for i in range(1, n + 1):
                new[i] = row[i - 1] + 1 if template[i - 1] == words[b] else max(row[i], new[i - 1])
            row = new
            if (row[n], a - b - 1) > (best[0], best[1] - best[2]):
                best = (row[n], a, b + 1)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_altered_notices_are_measured_like_by_full_alignment(seed):
    rng = random.Random(seed)
    index = licenses.Index(licenses.TEMPLATES)
    for name in ("gpl-3.0-line", "mit-permission", "bsd-redistribution"):
        template = index.words[name]
        notice = list(template)
        for _ in range(2):
            notice[rng.randrange(len(notice))] = rng.choice(WORDS)
        notice.insert(rng.randrange(len(notice)), "extra")
        words = [rng.choice(WORDS) for _ in range(30)] + notice + [rng.choice(WORDS) for _ in range(30)]
        matched, first, last = best_alignment(template, words)
        found = [f for f in licenses.scan(" ".join(words), index, 0.8) if f[0] == name]
        run = max((j - i for i in range(len(template)) for j in range(i, len(template) + 1)
                   if template[i:j] and " ".join(template[i:j]) in " ".join(words)), default=0)
        if matched >= 0.8 * len(template) and run >= 5:
            text = " ".join(words)
            assert [f[2] for f in found] == [matched]
            assert text[found[0][3] : found[0][4]].split() == words[first:last]


def test_spans_repeats_and_nested_notices(make):
    apache = licenses.TEMPLATES["apache-2.0-header"]
    docs = make(
        [(1, "Été. Released under the MIT License. and again released under the mit license", 1), (2, apache, 1),
         (3, "Licensed under CC BY-NC 4.0.", 1), (4, None, 1), (5, "nothing of the kind", 1), (None, "x " * 20_000 + "Released under the MIT License.", 1),
         (5, "Released under the MIT License", 1), (5, "Released under the MIT License", 1)],
        "doc_id long, text string, template int",
    )
    rows = sorted(((r.doc_id, r.template, r.coverage, r.start, r.end) for r in licenses.matches(docs).collect()), key=str)
    assert rows == sorted([
        (1, "mit-line", 1.0, 5, 35), (1, "mit-line", 1.0, 47, 77), (2, "apache-2.0-header", 1.0, 0, len(apache) - 1),
        (3, "cc-by-nc-4.0-line", 1.0, 0, 27), (None, "mit-line", 1.0, 40_000, 40_030),
        (5, "mit-line", 1.0, 0, 30), (5, "mit-line", 1.0, 0, 30),
    ], key=str)
    assert licenses.matches(docs.limit(0)).count() == 0


def test_templates_that_could_be_overlooked_are_refused():
    with pytest.raises(ValueError):
        licenses.Index({"short": "all rights reserved"})


def test_equal_runs_have_a_fingerprint_in_common():
    rng = random.Random(9)
    index = licenses.Index(licenses.TEMPLATES)
    for _ in range(200):
        run = [rng.choice(WORDS) for _ in range(licenses.K + licenses.WINDOW - 1)]
        one, two = ([rng.choice(WORDS) for _ in range(9)] + run + [rng.choice(WORDS) for _ in range(7)] for _ in range(2))
        a, b = (set(index.fingerprints(w)[0].tolist()) for w in (one, two))
        assert a & b


def test_notices_of_the_table_are_found(spark):
    from reddwatch.llm.queries import op6_licenses

    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {n: t.rstrip(".") for n, t in licenses.TEMPLATES.items() if n.endswith("-line")}
    wanted = {(r.doc_id, n) for r in docs.collect() for n, t in lines.items() if t in r.text}
    found = {(r.doc_id, r.template) for r in op6_licenses(spark, sf_dir).collect()}
    assert wanted and wanted <= found


@pytest.mark.parametrize(("text", "name", "matched"), [
    ("It is Released under an MIT License, so", "mit-line", 4),
    ("Released x under y the z MIT q License", "mit-line", 5),
    ("Licensed under the Apache Licence, Version 2.0", "apache-2.0-line", 7),
])
def test_short_notices_without_a_run_are_found(text, name, matched):
    found = licenses.scan(text, licenses.Index(licenses.TEMPLATES), 0.8)
    assert [(f[0], f[2]) for f in found] == [(name, matched)]


def in_band(template, words, band):
    """Whether any alignment around any word, displaced by the band at most, has share 0.8: all are tried."""
    need = 0.8 * len(template) - 1e-9
    return any(
        licenses.aligned(template, words, start, band)[0] >= need
        for start in range(-len(template), len(words) + 1)
    )


@pytest.mark.parametrize("seed", range(8))
def test_all_alignments_that_cover_enough_are_found(seed):
    rng = random.Random(seed)
    for n in (4, 5, 6, 7, 8, 11, 16, 23, 70):
        template = [f"w{rng.randrange(n)}" for _ in range(n)]
        index = licenses.Index({"t": " ".join(template)})
        for _ in range(6):
            notice = list(template)
            for _ in range(rng.randint(0, max(1, n // 4))):
                notice[rng.randrange(n)] = rng.choice(WORDS + template)
            for _ in range(rng.randint(0, 1 + n // 6)):
                notice.insert(rng.randrange(len(notice)), rng.choice(WORDS))
            words = rng.choices(WORDS, k=5) + notice + rng.choices(WORDS + template, k=6)
            found = licenses.scan(" ".join(words), index, 0.8)
            if n < licenses.LONG:
                assert bool(found) == in_band(template, words, licenses.band_of(n))
            else:
                matched, first, last = best_alignment(template, words)
                if matched >= 0.8 * n and last - first <= n + licenses.band_of(n):
                    assert found and found[0][2] >= matched


@pytest.mark.parametrize(("share", "kind"), [(0.8, (2, 1)), (0.9, (2, 2)), (0.97, (3, 2)), (0.6, (1, 1))])
def test_matches_share_as_many_fingerprints_as_the_index_asks_for(share, kind):
    rng = random.Random(11)
    for n in (61, 90, 200):
        template = [f"w{rng.randrange(2 * n)}" for _ in range(n)]
        index = licenses.Index({"t": " ".join(template)}, share=share)
        k, window, least = licenses.settings(n, share)
        assert (k, window) == kind and list(index.postings) == [kind]
        prints = set(index.fingerprints(template, k, window)[0].tolist())
        for _ in range(20):
            # As many words lost as may be, and as many put in as the span may have, all apart.
            words = list(template)
            for i in rng.sample(range(n), n - licenses.needed(n, share)):
                words[i] = None
            for i in sorted(rng.sample(range(1, n), licenses.band_of(n, share)), reverse=True):
                words.insert(i, "other")
            words = [w for w in words if w]
            assert sum(v in prints for v in index.fingerprints(words, k, window)[0].tolist()) >= least
            assert [f[0] for f in licenses.scan(" ".join(["x"] * 50 + words + ["y"] * 50), index, share)] == ["t"]
        assert not licenses.scan(" ".join(rng.sample(template, n)), index, share)


def test_an_index_serves_no_lower_share():
    index = licenses.Index({"t": "all rights are reserved here"}, share=0.9)
    with pytest.raises(ValueError):
        licenses.scan("all rights are reserved here", index, 0.8)


def test_long_notices_are_measured_like_by_full_alignment():
    rng = random.Random(5)
    index = licenses.common()
    template = index.words["mit"]
    notice = list(template)
    for _ in range(12):
        notice[rng.randrange(len(notice))] = rng.choice(WORDS)
        notice.insert(rng.randrange(len(notice)), rng.choice(WORDS))
    words = rng.choices(WORDS, k=40) + notice + rng.choices(WORDS, k=40)
    matched, first, last = best_alignment(template, words[30:-30])
    text = " ".join(words)
    found = [f for f in licenses.scan(text, index, 0.8) if f[0] == "mit"]
    assert [f[2] for f in found] == [matched]
    assert text[found[0][3] : found[0][4]].split() == words[30 + first : 30 + last]


def text_of(name):
    return licenses.TEMPLATES[name]


@pytest.mark.parametrize("name", [
    "agpl-3.0-header", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc0-1.0", "gpl-2.0", "gpl-2.0-header",
    "gpl-2.0-only-header", "gpl-3.0", "isc", "lgpl-2.1", "lgpl-3.0", "mit", "mpl-2.0", "mpl-2.0-header", "unlicense",
])
def test_whole_texts_are_told_apart(name):
    index = licenses.common()
    text = "Some words before. " + text_of(name) + " And some of the words after it."
    words = len(licenses.split(text_of(name))[0])
    found = licenses.scan(text, index, 0.8)
    assert [f[:3] for f in found] == [(name, words, words)]
    # The beginning alone is not the whole.
    half = " ".join(licenses.split(text_of(name))[0][: words // 2])
    assert all(f[0] != name for f in licenses.scan(half, index, 0.8))


def test_spdx_lines_are_found(make):
    docs = make([(1, "# SPDX-License-Identifier: MIT OR Apache-2.0\nimport os"), (2, "SPDX")], "doc_id long, text string")
    assert [(r.doc_id, r.template, r.coverage, r.start, r.end) for r in licenses.matches(docs).collect()] == [
        (1, "spdx:MIT OR Apache-2.0", 1.0, 2, 44)
    ]
