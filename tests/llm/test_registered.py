import re
from pathlib import Path

import pytest

import corpus_pipeline
from compare import difference, oracle_connection
from reddwatch.llm.queries import ORACLE, QUERIES


@pytest.fixture
def utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(utc, name):
    assert difference(utc, oracle_connection("/root/testdata/sf0.001"), "/root/testdata/sf0.001", name) is None


def test_all_operators_are_registered():
    import __spark_entry__

    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


def test_nothing_else_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("reddwatch/**/*.py"), *root.glob("tests/*.py"), root / "bench.py", root / "compare.py"]:
        if "llm" not in path.parts:
            assert "reddwatch.llm" not in path.read_text(), path


def test_pipeline_on_planted_documents(spark, make, tmp_path):
    """Each stage's decision takes effect, and clean documents come through whole."""
    import random

    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in ("an", "el", "or", "ut") for c in ("", "ka", "mi", "so")]
    fresh = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = {i: fresh(120) for i in range(120)}
    labels = []
    for i in range(0, 120):
        toxic = i % 4 == 0 and i < 60
        if toxic:
            docs[i] = fresh(40) + " zorrugrak " + fresh(10) + " zorrugrimm vleskot " + fresh(30)
        labels.append((i, 1, int(toxic)))
    docs[61] = docs[62]
    item = fresh(30)
    docs[70] = fresh(50) + " " + item + " " + fresh(40)
    passage = fresh(60)
    docs[80] = fresh(40) + " " + passage
    docs[81] = passage + " " + fresh(40)
    sf = str(tmp_path)
    rows = [(i, t, "en", "src", len(t)) for i, t in docs.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    make(rows, schema).write.parquet(f"{sf}/documents.parquet")
    make(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    make([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    at = spark.read.parquet(f"{sf}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    seen = [at]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, seen[-1], sf)
        assert after.dtypes == at.dtypes, name
        folder = f"{sf}/{name.replace(' ', '-')}"
        after.write.parquet(folder)
        seen.append(spark.read.parquet(folder))
    assert ids(seen[0]) - ids(seen[1]) == {i for i in range(60) if i % 4 == 0}
    assert ids(seen[1]) - ids(seen[2]) == {62}
    assert ids(seen[3]) == ids(seen[2])
    texts = {r.doc_id: r for r in seen[3].collect()}
    assert passage not in texts[81].text and passage in texts[80].text
    assert all(r.n_chars == len(r.text) for r in texts.values()) and texts[1].text == docs[1]
    assert ids(seen[3]) - ids(seen[4]) == {70}
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == ids(seen[4])


def test_pipeline_stages_are_the_five_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "drop_toxic", "drop_near_duplicates", "cut_repeats", "drop_leaks", "pack"
    ]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows(spark, make, tmp_path, empty):
    """Null ids, texts and further columns, empty texts, repeated rows, clashing names, and a table without rows."""
    sf = str(tmp_path)
    text = "plain words that stand in one document only number "
    rows = [(i, text + " ".join(f"w{i}x{j}" for j in range(30)), None, "s", 1, 0.5, "k") for i in range(12)]
    rows += [(20, None, "en", None, None, None, None), (21, "", None, None, 0, None, None), (None, "no id " * 20, None, None, 1, None, None)]
    rows += [(None, None, None, None, None, None, None), rows[3], rows[3]]
    schema = "doc_id long, text string, lang string, source string, n_chars int, score double, kept string"
    docs = make([] if empty else rows, schema)
    make([(0, None, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    make([(1, None), (None, ""), (2, "held nowhere at all in these documents here")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, sf)
        assert after.dtypes == docs.dtypes, name
        after.write.parquet(f"{sf}/{i}")
        docs = spark.read.parquet(f"{sf}/{i}")
    found = docs.collect()
    if empty:
        assert found == []
    else:
        assert {r.doc_id for r in found} >= set(range(12))
        assert sum(r.doc_id == 3 for r in found) >= 1 and all(r.kept in ("k", None) for r in found)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in found}
