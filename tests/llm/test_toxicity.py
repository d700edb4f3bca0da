import random
import zlib

import numpy as np
import pytest

from reddwatch.llm import toxicity


def corpus(n=800, seed=4):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "lo", "mi", "tu", "re", "sa") for b in ("no", "ti", "ke", "ru", "lda", "ment")]
    bad = ["grukka", "grukkent", "zorlich", "zorlment"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(10, 120))]
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(max(2, len(text) // 30)):
                text[rng.randrange(len(text))] = rng.choice(bad)
        docs.append((i, " ".join(text).capitalize() + ".", 0.5))
        if rng.random() < 0.6:
            labels.append((i, toxic))
    return docs, labels


def test_held_out_rows_and_unlabelled_toxic_texts_are_found(make):
    docs, labels = corpus()
    table = make(docs + [(None, None, 1.0), (None, "grukka zorlich", 1.0), (900, "", 1.0), docs[3]],
                 "doc_id long, text string, score double")
    marks = make(labels + [(None, 1), (5000, 1), (7, None)], "doc_id long, toxic int")
    rows = toxicity.scores(table, marks).collect()
    assert len(rows) == len(docs) + 4
    truth = {i: any(w.lower().strip(".").startswith(("gruk", "zor")) for w in t.split()) for i, t, _ in docs}
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is None:
            assert r.held_out is False
            continue
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id], r
        else:
            assert r.predicted == 0
    assert any(r.held_out and r.predicted for r in rows)


def test_only_labels_outside_the_held_out_rows_matter(make):
    docs, labels = corpus(200)
    table = make(docs, "doc_id long, text string, score double")
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    one, two = (toxicity.scores(table, make(x, "doc_id long, toxic int")).collect() for x in (labels, other))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_without_toxic_labels_all_scores_are_zero(make):
    table = make([(1, "a"), (2, None)], "doc_id long, text string")
    rows = toxicity.scores(table, make([(1, 0)], "doc_id long, toxic int")).collect()
    assert [r.score for r in rows] == [0.0, 0.0]
    assert toxicity.scores(table.limit(0), make([], "doc_id long, toxic int")).count() == 0
    assert toxicity.kept(table, make([], "doc_id long, toxic int")).count() == 2


def test_kept_rows_have_all_columns(make):
    docs, labels = corpus(300)
    table = make(docs, "doc_id long, text string, score double")
    kept = toxicity.kept(table, make(labels, "doc_id long, toxic int"))
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {
        i for i, t, _ in docs if not any(w.lower().startswith(("gruk", "zor")) for w in t.split())
    }


def test_unlabelled_positives_are_found_by_the_corrected_risk():
    """Toxic texts share a feature; a third of the unlabelled texts are toxic, and none of them is marked."""
    rng = np.random.default_rng(0)
    positive = [(np.array([0]), np.ones(1)) for _ in range(50)]
    truth = rng.random(300) < 0.33
    unlabelled = [(np.array([0 if t else 1]), np.ones(1)) for t in truth]
    w, b = toxicity.fit(positive, unlabelled, 0.33, 2, 0)
    assert w[0] + b > 1 and w[1] + b < -1


@pytest.mark.parametrize("text", ["", None])
def test_features_of_nothing(text):
    columns, values = toxicity.vector(toxicity.Features(np.array([1, 2])), text or "")
    assert len(columns) == len(values) == 0


def test_held_out_quality_on_the_table(spark):
    from reddwatch.llm.queries import op2_toxicity

    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in op2_toxicity(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted and labels[r.doc_id] for r in rows)
    assert right / sum(labels[r.doc_id] for r in rows) > 0.9
    assert right / max(1, sum(r.predicted for r in rows)) > 0.9


def test_words_of_a_small_part_of_the_toxic_texts_are_learnt(make, monkeypatch):
    """A word that hardly any of the texts drawn for fitting has, but a hundred labelled toxic texts in all."""
    monkeypatch.setattr(toxicity, "POSITIVE", 60)
    monkeypatch.setattr(toxicity, "UNLABELLED", 180)
    docs, labels = corpus(6000)
    rng = random.Random(1)
    rare = [i for i in range(6000, 6150)]
    docs += [(i, " ".join(["banno", "loti", "mike", "turu"] * rng.randint(3, 9) + ["qwelbax", "qwelbax"]), 0.5) for i in rare]
    labels += [(i, 1) for i in rare[:110]]
    rows = toxicity.scores(
        make(docs, "doc_id long, text string, score double"), make(labels, "doc_id long, toxic int")
    ).collect()
    truth = {i: any(w.lower().strip(".").startswith(("gruk", "zor", "qwel")) for w in t.split()) for i, t, _ in docs}
    missed = [r for r in rows if r.doc_id in rare and not r.predicted]
    assert not missed
    assert sum(r.predicted != truth[r.doc_id] for r in rows) < 0.02 * len(rows)
