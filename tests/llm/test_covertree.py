import math
import random

import numpy as np
import pytest

from reddwatch.llm import covertree


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * x) if abs(x) < 2.0**53 else 256 * int(x) for x in vector]


def slow(rows, anchors, k=5, low=80, high=100):
    order = lambda i: (i is None, i)
    pool = [(i, label, w) for i, v, label in rows if label is not None and (w := whole(v)) is not None]
    out = []
    for a, v, label in anchors:
        if label is None or (q := whole(v)) is None:
            continue
        scored = [(-sum(x * y for x, y in zip(q, w)), order(i), lab) for i, lab, w in pool if len(w) == len(q)]
        positives = sorted(s for s in scored if s[2] == label and s[1] != order(a))[:k]
        for ps, p, _ in positives:
            fits = sorted(s for s in scored if s[2] != label and low * -ps <= 100 * -s[0] <= high * -ps)
            out += [(a, p[1], r + 1, n[1], -ps, -ns) for r, (ns, n, _) in enumerate(fits[:k])]
    return sorted(out, key=str)


def corpus(seed, n=260, size=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        centre = i % 4
        rows.append((i, [rng.gauss(1.0 if j == centre else 0.0, 0.2) for j in range(size)], rng.randrange(3)))
    rows += [(n + i, list(rows[7][1]), i % 3) for i in range(40)]  # one vector many times
    rows += [
        (900, None, 1), (901, [None] * size, 1), (902, [float("nan")] * size, 0), (903, [float("inf")] + [0.0] * (size - 1), 0),
        (904, [], 1), (905, [], 1), (906, [], 2), (907, [1.0, -1.0], 1), (908, [1.0, -0.9], 1), (909, [0.9, -0.9], 0),
        (910, [0.0] * size, 1), (911, [5.0] * size, None), (None, [0.7] * size, 1), (None, [0.6] * size, 2), rows[20], rows[20],
        (912, [-1.0, 0.5, 0.1], 1), (913, [-2.0, 0.5, 0.1], 1), (914, [-3.0, 0.5, 0.1], 4),
    ]
    rng.shuffle(rows)
    return rows


def mined(make, rows, anchors, **named):
    schema = "vec_id long, embedding array<double>, label int, number int, size string"
    table = make([(*r, 1, "x") for r in rows], schema).repartition(3)
    asked = make([(*r, 1, "x") for r in anchors], schema)
    found = covertree.hard_negatives(table, asked, **named)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("seed,block,together", [(1, None, 256), (2, 40, 7), (3, 1, 3)])
def test_negatives_are_those_of_all_pairs(make, seed, block, together):
    rows = corpus(seed)
    anchors = [r for r in rows if r[0] is None or r[0] % 10 == 0 or 900 <= r[0]]
    assert mined(make, rows, anchors, block=block, together=together) == slow(rows, anchors)


def test_numbers_beyond_doubles_and_longs(make):
    rows = [(0, [1e6, 1.0], 0), (1, [7e4, 0.0], 0), (2, [8e4, 0.0], 0), (3, [7.5e4, 0.0], 1), (4, [6.0e4, 0.0], 1)]
    rows += [(5, [0.0, 1e30], 1), (6, [0.0, -1e30], 0)]
    anchors = [rows[0]]
    found = mined(make, rows[:5], anchors)
    assert found == slow(rows[:5], anchors)
    assert found[0][:5] == (0, 1, 1, 4, 256000000 * 17920000)
    # Scores that do not fit a long matter only if they are among the results.
    flat = [(0, [1e6, 0.0], 0)] + rows[1:]
    assert mined(make, flat, [flat[0]]) == slow(flat, [flat[0]])
    low = [*rows[:5], (7, [-1e30, 0.0], 0), (8, [-1e31, 0.0], 0)]
    found = mined(make, low, [low[0]], positives=2)
    assert found == slow(rows[:5], [rows[0]], 5)
    with pytest.raises(Exception, match="does not fit a long"):
        mined(make, [(0, [1e30, 0.0], 0), (1, [1e30, 0.0], 0)], [(0, [1e30, 0.0], 0)])


def test_no_rows(make):
    rows = corpus(1)[:30]
    assert mined(make, [], [r for r in rows if r[0]]) == []
    assert mined(make, rows, []) == []
    assert mined(make, [(0, [1.0], 1)], [(0, [1.0], 1)]) == []


@pytest.mark.parametrize("n,size", [(1, 3), (500, 4), (300, 40), (64, 0)])
def test_tree_covers_its_members_level_by_level(n, size):
    rng = np.random.default_rng(n)
    matrix = np.floor(256 * rng.normal(size=(n, size))).astype(np.int64)
    matrix[n // 2 :] = matrix[: n - n // 2]
    points, length = covertree.augmented(matrix)
    assert np.allclose(np.linalg.norm(points, axis=1), length)
    order, tree = covertree.covered(points, length)
    assert sorted(order.tolist()) == list(range(n))
    for i in range(len(tree)):
        mine = points[order[tree.begin[i] : tree.end[i]]]
        assert np.linalg.norm(mine - mine[0], axis=1).max() <= tree.radius[i] + 1e-9
        children = list(range(tree.first[i], tree.last[i]))
        if children:
            assert tree.begin[children[0]] == tree.begin[i] and tree.end[children[-1]] == tree.end[i]
            assert all(tree.end[a] == tree.begin[b] for a, b in zip(children, children[1:]))
            assert tree.radius[children].max() <= tree.radius[i] / 1.0 and len(children) > 1
    again = covertree.CoverTree.unpacked(tree.packed())
    assert np.array_equal(again.end, tree.end) and np.array_equal(again.radius, tree.radius)


def test_search_leaves_nodes_out(monkeypatch):
    """On clustered vectors most leaves are never scored."""
    rng = np.random.default_rng(4)
    matrix = np.floor(256 * (np.repeat(rng.normal(size=(40, 8)), 50, axis=0) + rng.normal(scale=0.02, size=(2000, 8)))).astype(np.int64)
    order, tree = covertree.covered(*covertree.augmented(matrix))
    names = ["number", "size", "ids", "labels", "data", "wide"]
    ids = np.arange(2000)
    row = {n: a[0].as_py() for n, a in zip(names, covertree.stored(0, ids[order], ids[order] % 3, matrix[order]))}
    index = covertree.Index({**row, "tree": tree.packed()})
    seen = []
    scored = index.scored
    index.scored = lambda at, query: (seen.append(len(at)), scored(at, query))[1]
    windows = covertree.Windows([-math.inf], [math.inf], 5)
    index.search(matrix[17], np.ones(2000, dtype=bool), windows)
    products = matrix @ matrix[17]
    assert windows.best[0] == sorted(((int(s), i) for i, s in enumerate(products)), key=lambda x: (-x[0], x[1]))[:5]
    assert sum(seen) < 500
