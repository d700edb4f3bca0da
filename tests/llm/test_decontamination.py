import math
import random
import re

import pytest

from reddwatch.llm import decontamination


def slow(docs, items, size, share):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = []
    for item_id, text in set(items):
        words = split(text)
        n = min(size, len(words))
        if not n:
            continue
        wanted = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        for doc_id, doc in docs:
            w = split(doc)
            held = len(wanted & {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
            if held >= math.ceil(share * len(wanted) - 1e-9):
                out.append((doc_id, item_id, len(wanted), held))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Été", "漢字", "x1"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 6, 9, 20, 40, 65])))) for i in range(30)]
    items += [(0, items[0][1]), (50, None), (51, " ,. "), (None, items[5][1]), (3, "another text with the same id as one")]
    docs = []
    for i in range(60):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items)[1] or ""
            passage = passage.upper().split()
            for _ in range(rng.randint(0, 3)):
                if passage:
                    passage[rng.randrange(len(passage))] = rng.choice(words)
            at = rng.randint(0, len(parts))
            parts[at:at] = passage
        docs.append((i, ", ".join(parts)))
    return docs + [(60, None), (61, ""), (None, items[7][1]), docs[0], docs[0]], items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("inline,size", [(20_000, 1 << 24), (3, 1 << 24), (20_000, -1), (3, -1)])
def test_matches_are_those_of_all_pairs(make, seed, inline, size):
    docs, items = corpus(seed)
    d = make([(*r, 1) for r in docs], "doc_id long, text string, item_id int").repartition(2)
    b = make([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    rows = decontamination.matches(d, b, inline=inline, broadcast_bytes=size).collect()
    assert all(r.containment == r.n_shared / r.n_shingles for r in rows)
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in rows), key=str) == slow(docs, items, 5, 0.8)


def test_clean_documents_stay(make):
    docs, items = corpus(3)
    d = make([(*r, 1) for r in docs], "doc_id long, text string, words int")
    kept = decontamination.clean(d, make(items, "item_id long, text string"))
    held = {r[0] for r in slow(docs, items, 5, 0.8)}
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in held)


def test_empty_tables(make):
    docs = make([(1, "a b c d e f")], "doc_id long, text string")
    items = make([(1, "a b c d e f")], "item_id long, text string")
    assert decontamination.matches(docs, items.limit(0)).count() == 0
    assert decontamination.matches(docs.limit(0), items).count() == 0
    assert decontamination.clean(docs, items.limit(0)).count() == 1
    assert decontamination.matches(docs, items).count() == 1


def test_the_main_path_has_no_python(make):
    docs, items = corpus(4)
    d, b = make(docs, "doc_id long, text string"), make(items, "item_id long, text string")
    for inline, size in ((20_000, 1 << 24), (3, 1 << 24), (3, -1)):
        plan = decontamination.matches(d, b, inline=inline, broadcast_bytes=size)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_many_items_of_one_text_are_looked_for_once(make):
    text = " ".join(f"w{i}" for i in range(400))
    items = make([(i, text) for i in range(5000)], "item_id long, text string")
    docs = make([(1, "before " + text + " after"), (2, "w1 w2 w3 w4 w5 w6")], "doc_id long, text string")
    found = decontamination.matches(docs, items)
    rows = found.collect()
    assert {(r.doc_id, r.n_shingles, r.n_shared) for r in rows} == {(1, 396, 396)}
    assert sorted(r.item_id for r in rows) == list(range(5000))
    sketched = decontamination.sketches(items.select("text").distinct(), 5, 0.8)
    assert sketched.count() == 1 and sketched.first().partition == 9


def test_documents_out_of_a_shuffle(make):
    docs, items = corpus(5)
    d = make(docs, "doc_id long, text string").repartition(5, "text")
    rows = decontamination.matches(d, make(items, "item_id long, text string"), inline=3).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in rows), key=str) == slow(docs, items, 5, 0.8)
