"""Landed detection reports: comma-separated UTF-16LE with a header."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reddwatch import schemas
from reddwatch.sources.blocks import records

ENCODING = "UTF-16LE"
# With enforceSchema off, a file whose header differs from the first one raises instead of
# having its columns swapped by position; `read_landed` looks at each file's header itself. A quote inside a quoted field is doubled.
CSV_OPTIONS = {
    "header": True,
    "encoding": ENCODING,
    "escape": '"',
    "nullValue": "NA",
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "enforceSchema": False,
}
# The default line splitter reads UTF-16 as garbage without an error. Parsing a file whole takes
# line breaks inside quotes but makes the file one task; a given line end can be split.
WHOLE_FILES = {"multiLine": True}
# Where a field holds a line break after all, a line has too few fields. All columns are parsed,
# so that it is seen, and the read fails instead of filling up the row.
SPLIT_LINES = {"lineSep": "\n", "mode": "FAILFAST", "columnPruning": False}


# Fields may hold line breaks and files are read in parallel all the same, see `sources.blocks`.
BLOCKS = "blocks"
# What the parser of single records needs of the options.
RECORD_OPTIONS = {
    name: str(CSV_OPTIONS[name]).lower() if name != "nullValue" else CSV_OPTIONS[name]
    for name in ("escape", "nullValue", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace")
}


def line_options(line_breaks: bool | str) -> dict[str, object]:
    """How files are cut into rows; the same for batch, ingest and the command line.

    With `line_breaks` (the default everywhere) fields may hold line breaks and each file is
    parsed whole, by one task. Without, files are split at line ends, which large files need;
    a file with a line break in a field then fails. With `BLOCKS` fields may hold line breaks, and the records of
    a file are found block by block, which moves its lines once. The size of a file never decides.
    """
    return WHOLE_FILES if line_breaks else SPLIT_LINES


def read_report(
    spark: SparkSession, *paths: str, line_breaks: bool | str = True, arrival: bool = False
) -> DataFrame:
    """All-text report rows. Each path has its own column order; columns are matched by name.

    With `arrival`, rows carry the file they came from and when it was written.
    """
    if line_breaks == BLOCKS:
        rows = _all_landed(spark, paths, list(schemas.REPORT_HEADERS.values()))
        return rows if arrival else rows.drop("_source_time", "_source_file")
    parts = []
    for path in paths:
        rows = _read(spark, path, line_options(line_breaks))
        needed = _needed(rows, list(schemas.REPORT_HEADERS))
        parts.append(rows.select(*needed, *(_arrival() if arrival else ())))
    return _union(parts)


def read_downstream(spark: SparkSession, *paths: str, line_breaks: bool | str = True) -> DataFrame:
    """The tag column of the downstream report."""
    tag = schemas.REPORT_HEADERS["tag"]
    if line_breaks == BLOCKS:
        return _all_landed(spark, paths, [tag]).select(F.col(f"`{tag}`").alias("pit_id"))
    return _union([
        _select_needed(
            _read(spark, path, line_options(line_breaks)), ["tag"]
        ).withColumnRenamed(tag, "pit_id")
        for path in paths
    ])


# What is kept of a file that is set aside.
SET_ASIDE = "file string, header string, n_lines long"
# Fixed by Spark: the columns of its reader of whole files. Only names and sizes are asked for.
FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"


def header_index(spark: SparkSession, *paths: str) -> DataFrame:
    """The first line of every landed file and how many lines it has; a file without any has no row.

    Lines are cut and counted where the files are read, none of them is parsed. A line in a file's
    first block is the first one if none before it in that block is.
    """
    lines = spark.read.options(lineSep="\n", encoding=ENCODING).text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ).withColumn("place", F.when(F.col("block") == 0, F.monotonically_increasing_id()))
    # Such lines come as they are in the file.
    header = F.decode(F.min_by(F.col("value").cast("binary"), F.col("place")), ENCODING)
    return lines.groupBy("file").agg(header.alias("header"), F.count(F.lit(1)).alias("n_lines"))


def header_columns(header: str | None, wanted: list[str] | None = None) -> list[str] | None:
    """The columns a header line names, None if it lacks one that is wanted (all that a report has unless given) or
    names it twice.

    Further columns may repeat or have no name; they get names of their own.
    """
    wanted = wanted or list(schemas.REPORT_HEADERS.values())
    line = (header or "").lstrip("\ufeff").rstrip("\r")
    names = [name.strip() for name in next(csv.reader([line]), [])]
    if any(names.count(h) != 1 for h in wanted):
        return None
    return [name if name in wanted else f"_column_{i}" for i, name in enumerate(names)]


def read_landed(
    spark: SparkSession, *paths: str, line_breaks: bool | str = True, wanted: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Report rows with their arrival, and the files that are set aside, of files in any shapes.

    Files are put together by their header, and each shape is read by a reader of its own, so columns
    may stand in any order and others among them. A file whose first line lacks a column of a report (or one of
    `wanted`) is no report: it is set aside with that line and its number of lines, and the others are read. The
    names and first lines of the files are gathered as any listing of them is.
    """
    wanted = wanted or list(schemas.REPORT_HEADERS.values())
    found = header_index(spark, *paths).collect() if paths else []
    shapes: dict[tuple[bool, tuple[str, ...]], list[str]] = {}
    odd = []
    for row in sorted(found, key=lambda r: r.file):
        columns = header_columns(row.header, wanted)
        if columns is None:
            odd.append((unquote(row.file), (row.header or "").lstrip("\ufeff").rstrip("\r"), row.n_lines))
        else:
            returns = (row.header or "").endswith("\r")
            shapes.setdefault((returns, tuple(columns)), []).append(as_pattern(unquote(row.file)))
    parts = [
        _parsed(spark, files, columns, wanted, returns) if line_breaks == BLOCKS
        else _scanned(spark, files, columns, wanted, line_options(line_breaks))
        for (returns, columns), files in shapes.items()
    ]
    if not parts:
        kinds = [f"`{h}` string" for h in wanted]
        empty = ", ".join([*kinds, "_source_time timestamp", "_source_file string"])
        parts = [spark.createDataFrame([], empty)]
    return _union(parts), spark.createDataFrame(odd, SET_ASIDE)


def _scanned(
    spark: SparkSession, files: list[str], columns: tuple[str, ...], wanted: list[str], lines: dict[str, object]
) -> DataFrame:
    """Files of one shape, read by Spark's reader of files."""
    options = {**CSV_OPTIONS, **lines, "enforceSchema": True}
    return spark.read.options(**options).schema(_text_columns(columns)).csv(files).select(
        *[f"`{h}`" for h in wanted], *_arrival()
    )


def _parsed(
    spark: SparkSession, files: list[str], columns: tuple[str, ...], wanted: list[str], returns: bool
) -> DataFrame:
    """Files of one shape by blocks: records are found first and then parsed one by one. Empty lines are none;
    with `returns` lines end in a carriage return too, which rows do not keep, as in whole files."""
    found = records(spark, files, ENCODING).filter(~F.col("first"))
    if returns:
        found = found.withColumn("value", F.regexp_replace("value", r"\r(?=\n|\z)", ""))
    row = F.from_csv("value", _text_columns(columns), RECORD_OPTIONS).alias("row")
    return found.filter("value != ''").select(row, "time", "file").select(
        *[F.col(f"row.`{h}`").alias(h) for h in wanted],
        F.col("time").alias("_source_time"), F.col("file").alias("_source_file"),
    )


def _text_columns(columns: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def _all_landed(spark: SparkSession, paths: tuple[str, ...], wanted: list[str]) -> DataFrame:
    """Rows of files that must all have the wanted columns."""
    rows, aside = read_landed(spark, *paths, line_breaks=BLOCKS, wanted=wanted)
    if odd := aside.first():
        raise ValueError(f"{odd.file} lacks columns of a report: {odd.header}")
    return rows


def as_pattern(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def stream_files(
    spark: SparkSession, landing: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Names of newly landed files; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_COLUMNS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing).select("path")


def _arrival() -> tuple[Column, Column]:
    return (
        F.col("_metadata.file_modification_time").alias("_source_time"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def _read(spark: SparkSession, path: str, lines: dict[str, object]) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS, **lines).csv(path)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _needed(rows: DataFrame, names: list[str]) -> list[str]:
    headers = [schemas.REPORT_HEADERS[name] for name in names]
    absent = [h for h in headers if h not in rows.columns]
    if absent:
        raise ValueError(f"report lacks columns {absent}")
    return [f"`{h}`" for h in headers]


def _select_needed(rows: DataFrame, names: list[str] | None = None) -> DataFrame:
    return rows.select(*_needed(rows, names or list(schemas.REPORT_HEADERS)))
