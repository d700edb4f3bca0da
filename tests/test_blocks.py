"""Files read by blocks hold the same rows as files read whole, wherever blocks begin."""

import random

import golden as g
import pytest
from pyspark.sql import functions as F

from reddwatch.operators.detections import conform
from reddwatch.sources import reports
from reddwatch.sources.blocks import ends_in_quotes, records


def blocks_of(spark, size):
    """A session in which files are cut into blocks of so many bytes."""
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    small.conf.set("spark.sql.files.openCostInBytes", "1")
    return small


def write(path, text):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_bytes(text.encode("utf-16-le"))


def any_field(rng):
    kind = rng.random()
    if kind < 0.4:
        return rng.choice(["a", "NA", "", " b c ", "é", "stray \" quote", "x\"", "a \"b\" c"])
    inner = "".join(rng.choice(["a", ",", "\n", '""', " ", "\n\n", "b", '"",""']) for _ in range(rng.randrange(6)))
    after = rng.choice(["", "", "", " ", "after", ' "']) if kind > 0.9 else ""
    return rng.choice(["", " "]) + f'"{inner}"' + after


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_any_fields_are_read_as_in_whole_files(spark, tmp_path, seed, newline):
    rng = random.Random(seed)
    for f in range(4):
        lines = [",".join(g.HEADER)]
        lines += [",".join(any_field(rng) for _ in g.HEADER) for _ in range(60)]
        if f == 0:
            lines.append("")
        text = "\n".join(lines) + rng.choice(["", "\n"])
        if f == 3:
            text += '"never ends, "" \n a,b\n"",'
        write(tmp_path / f"{f}.csv", ("﻿" if f == 1 else "") + text.replace("\n", newline))
    whole, _ = reports.read_landed(spark, str(tmp_path))
    expected = g.rows_of(whole.drop("_source_time"))
    assert len(expected) > 200
    for size in (50, 311, 4001, 1 << 20):
        found, aside = reports.read_landed(blocks_of(spark, size), str(tmp_path), line_breaks=reports.BLOCKS)
        assert g.rows_of(found.drop("_source_time")) == expected
        assert aside.count() == 0


def state_after(line, inside):
    """The same by walking over the characters."""
    state = "quoted" if inside else "new"
    for c in line:
        if state == "new":
            state = "quoted" if c == '"' else "new" if c == "," or c <= " " else "plain"
        elif state == "quoted":
            state = "seen" if c == '"' else "quoted"
        elif state == "seen" and c == '"':
            state = "quoted"
        else:
            state = "new" if c == "," else "plain"
    return int(state == "quoted")


def test_states_of_lines(spark):
    rng = random.Random(4)
    lines = ["".join(rng.choices('"", ab', k=rng.randrange(12))) for _ in range(3000)]
    lines += ['"' * n for n in range(8)] + ["a" * 50_000 + '"', '"' + "a," * 20_000, '"",' * 5000 + '"x']
    found = spark.createDataFrame([(x,) for x in lines], "line string").repartition(2).select(
        "line", ends_in_quotes(F.col("line"), False).alias("a"),
        ends_in_quotes(F.col("line"), True).alias("b"),
    ).collect()
    assert len(found) == len(lines)
    for row in found:
        assert (row.a, row.b) == (state_after(row.line, False), state_after(row.line, True)), row.line[:60]


def test_a_record_over_many_blocks(spark, tmp_path):
    long = "\n".join(f"line {i}, \"\"and\"\" so on" for i in range(500))
    write(tmp_path / "r.csv", f'head\nx,"{long}",y\nz\n')
    small = blocks_of(spark, 97)
    found = sorted((r.first, r.value) for r in records(small, [str(tmp_path)], reports.ENCODING).collect())
    assert found == [(False, f'x,"{long}",y'), (False, "z"), (True, "head")]


def test_reports_and_downstream_by_blocks(spark, tmp_path):
    g.write_report(f"{tmp_path}/r.csv")
    found = reports.read_report(spark, str(tmp_path), line_breaks=reports.BLOCKS)
    assert g.rows_of(conform(found)) == g.rows_of(conform(g.report(spark)))
    write(tmp_path / "down" / "d.csv", 'Flag,Tag\n"a\nb",3DD.1\nc,3DD.2\n')
    tags = reports.read_downstream(blocks_of(spark, 7), f"{tmp_path}/down", line_breaks=reports.BLOCKS)
    assert sorted(r.pit_id for r in tags.collect()) == ["3DD.1", "3DD.2"]
    with pytest.raises(ValueError, match="lacks columns"):
        reports.read_report(spark, f"{tmp_path}/down", line_breaks=reports.BLOCKS)
