import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reddwatch.llm import radix, trie


def regrown(rows, every=5, most=9):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = own.get(c - c % every, [])[:h] + turns[h:]
    return out


def slow(sequences):
    members, ended = defaultdict(list), defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ended[tuple(turns)].append(c)
    rows = {}
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        rows[p] = (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(len(q) == len(p) + 1 for q in below),
            sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
            hashlib.sha256(",".join(map(str, sorted(ended[p]))).encode()).hexdigest(),
        )
    return sorted(rows.values(), key=str)


def corpus(seed, n=90):
    rng = random.Random(seed)
    texts = ["", "a", "bé", "hello there", "日本", "x" * 50, None]
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 4, 8, 12])):
            hot = rng.random() < 0.6
            rows.append((c, t, "user" if hot else rng.choice(["user", "assistant", None]), "a" if hot else rng.choice(texts)))
    rows += [(200, None, "system", "first"), (200, 1, "user", "a"), (None, 0, "user", "a"), (None, None, None, None)]
    rows += [(201, i, "user", "deep") for i in range(60)] + [(202, i, "user", "deep") for i in range(61)]
    rows += [(207, 0, "user", "a")] * 2 + [(500 + i, 0, "user", "copy") for i in range(0, 200, 5)]
    rng.shuffle(rows)
    return rows


def tree(make, rows, block, parts=3):
    schema = "conv_id long, turn long, role string, text string, key string, depth int"
    table = make([(*r, "key", 1) for r in rows], schema).repartition(parts)
    found = trie.nodes(trie.regrown(trie.sequences(table)), block=block)
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("seed,block", [(1, 20_000), (2, 7), (3, 1), (4, 2)])
def test_nodes_are_those_of_brute_force(make, seed, block):
    rows = corpus(seed)
    assert tree(make, rows, block) == slow(regrown(rows))


def test_copies_are_dealt_over_rows_and_hash_as_one(make, monkeypatch):
    monkeypatch.setattr(trie, "TOGETHER", 7)
    rows = [(i, 0, "user", "same") for i in range(300)] + [(i, 1, "user", "same") for i in range(300)]
    assert tree(make, rows, 3) == slow(regrown(rows))


def test_conversations_without_turns_and_none(make):
    rows = [(4, 0, "user", "gone")]  # the start is absent, its own turn replaced
    assert zlib.crc32(b"4") % 9 > 0
    assert tree(make, rows, 5) == [(4, 0, None, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest())] == slow(regrown(rows))
    assert tree(make, [], 5, parts=1) == []
    assert tree(make, [(None, 0, "user", "x")], 5) == []


@pytest.mark.parametrize("n", [3, 10, 40, 200, 256])
def test_layouts_grow_with_their_children(n):
    t = radix.Tree()
    keys = [bytes([b]) + b"tail" for b in random.Random(n).sample(range(256), n)]
    for k in keys:
        t.put(k, k)
    kind = type(t.root.children)
    assert kind is (radix.Few if n <= 16 else radix.Indexed if n <= 48 else radix.Direct)
    assert [b for b, _ in t.root] == sorted(k[0] for k in keys)
    assert all(t.root.children.find(k[0]).value == k for k in keys)


def test_tree_has_the_keys_in_order():
    rng = random.Random(5)
    keys = {bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12))) for _ in range(500)} | {b"a" * 400, b"a" * 399 + b"b"}
    t = radix.Tree()
    for k in rng.sample(sorted(keys), len(keys)):
        t.put(k, k)

    def walk(node, before):
        at = before + node.path
        if node.value is not None:
            assert node.value == at
            yield at
        for byte, child in node:
            yield from walk(child, at + bytes([byte]))

    assert list(walk(t.root, b"")) == sorted(keys)
