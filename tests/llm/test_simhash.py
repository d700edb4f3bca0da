import random

import numpy as np
import pytest
import xxhash

from reddwatch.llm import simhash
from reddwatch.llm.components import components


def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in lowered:
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    words += [word] if word else []
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    values = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def slow_components(rows, distance):
    prints = [slow_fingerprint(t or "") for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    least = {}
    for (doc_id, _), x in zip(rows, label):
        if doc_id is not None:
            least[x] = min(least.get(x, doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(x)) for (d, _), p, x in zip(rows, prints, label)), key=str)


@pytest.mark.parametrize("text", [
    "", "   ", "One", "Ä b", "A b C d", "a\x0bb\x0cc\r\nd\x1ce f g h i", "the the the the the", "ÉCOLE École x y z",
])
def test_fingerprint_of_a_text(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_shingle_hashes_are_those_of_spark(spark):
    from pyspark.sql import functions as F

    value = spark.range(1).select(F.xxhash64(F.lit("a bé c"))).first()[0]
    assert value & (1 << 64) - 1 == xxhash.xxh64_intdigest("a bé c".encode(), 42)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 200))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            if text:
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i * 7 % n, " ".join(text)))
    return rows + [(1000, None), (1001, ""), (None, rows[0][1]), rows[1], (None, "only here"), (None, "only here")]


@pytest.mark.parametrize("seed,hot", [(1, 4096), (2, 2)])
def test_components_are_those_of_all_pairs(make, seed, hot):
    rows = corpus(seed)
    docs = make([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string").repartition(3)
    found = simhash.near_duplicates(docs, hot=hot)
    assert sorted(map(tuple, found.collect()), key=str) == slow_components(rows, 2)


def test_one_row_of_each_component_stays(make):
    rows = corpus(3)
    docs = make([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    kept = simhash.representatives(docs).collect()
    groups = {}
    for d, fp, c in slow_components(rows, 2):
        groups.setdefault(c if c is not None else f"null {fp}", []).append(d)
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp"}
    assert sorted((str(r.doc_id) for r in kept)) == sorted(
        "None" if isinstance(c, str) else str(c) for c in groups
    )


def test_no_rows(make):
    docs = make([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.representatives(docs).count() == 0


def test_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 30, 3)).astype(np.uint64)
    values = np.unique(np.concatenate([centres, (centres[:, None] ^ np.bitwise_xor.reduce(flips, 2)).ravel()]))
    tree = simhash.Tree(values)
    who, node = tree.near(tree.values, 2)
    far = np.bitwise_count(tree.values[:, None] ^ tree.values[None, :])
    assert set(zip(who.tolist(), node.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(far <= 2))))


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_of_a_dense_cloud_over_all_levels(make, distance):
    rng = random.Random(distance)
    values = {0}
    while len(values) < 300:
        v = rng.choice(sorted(values))
        values.add(v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = make([(v,) for v in signed], "fp long")
    found = components(simhash.links(fps, distance, hot=3)).distinct().collect()
    root = {r.vertex: r.root for r in found}
    label = {v: v for v in signed}
    for _ in range(40):
        for a in signed:
            for b in signed:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                    label[a] = label[b] = min(label[a], label[b])
    mine = {}
    for v in signed:
        mine.setdefault(root.get(v, v), set()).add(v)
    theirs = {}
    for v in signed:
        theirs.setdefault(label[v], set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_chains_and_stars(make):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 299), (299, 300)]
    found = {r.vertex: r.root for r in components(make(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(41)} | {200 + i: 100 for i in range(30)} | {100: 100, 299: 299, 300: 299}
    assert found == expected
    assert components(make([], "a long, b long")).count() == 0
