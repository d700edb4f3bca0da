"""Records of report files whose fields may hold line breaks, read in parallel by blocks.

A line break ends a record unless it is in quotes, and whether it is depends on all text before it. Each line,
without looking further, says where a reader is at its end (in quotes or not) if it began inside quotes, and where if
outside. These small functions are composed: over the lines of a block, over the blocks of a file, one row each,
and then every line knows where it begins. Quotes count only where a field begins with one, as in Spark's reader, so
stray ones do not turn what follows inside out, as the parity of quotes would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the format, as Spark reads it: characters up to the blank are left out at the ends of a field; a field is
# in quotes if it begins with one; a quote in quotes is doubled; what follows a closing quote belongs to the field.
_BLANKS = r"[\x00-\x20]*+"
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'\G{_BLANKS}(?:"{_QUOTED}"[^,]*+|(?!")[^,]*+),'
_LEFT_OPEN = rf'^{_BLANKS}"{_QUOTED}$'
_ALL_QUOTED = rf"^{_QUOTED}$"
_REST_OF_QUOTED = rf'^{_QUOTED}"[^,]*+,?'


def ends_in_quotes(line: Column, begins_in_quotes: bool) -> Column:
    """1 if the reader is in quotes at the end of the line, else 0."""
    if begins_in_quotes:
        rest = F.regexp_replace(line, _REST_OF_QUOTED, "")
        inside = line.rlike(_ALL_QUOTED) | _leaves_open(rest)
    else:
        inside = _leaves_open(line)
    return F.when(F.contains(line, F.lit('"')), inside.cast("int")).otherwise(int(begins_in_quotes))


def _leaves_open(fields: Column) -> Column:
    """Whether the last field, once all that end with a comma are taken off, is in quotes that do not end."""
    return F.regexp_replace(fields, _FIELD, "").rlike(_LEFT_OPEN)


def lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Every line with its file, block and place in it. A line that cuts a character in two, as a line end found
    between two characters makes, stops the job."""
    raw = spark.read.options(lineSep="\n", encoding=encoding).text(paths).select(
        F.col("value").cast("binary").alias("bytes"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    broken = F.raise_error(F.concat(F.lit("a line of half a character in "), "file")).cast("string")
    line = F.when(F.octet_length("bytes") % 2 == 0, F.decode("bytes", encoding)).otherwise(broken)
    return raw.withColumn("line", line).drop("bytes")


def records(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """file, time, first (is it the file's first record?) and value, one row for each record, its line breaks included.

    A block's lines are sorted in one task, and only the lines of records that have several are moved once more. An
    opening quote without an end makes one record of all that follows, as it does for a reader of whole files.
    """
    read = lines(spark, paths, encoding).select(
        "*", ends_in_quotes(F.col("line"), False).alias("out"), ends_in_quotes(F.col("line"), True).alias("in"),
    ).select(
        "file", "time", "block", "place", "line", *_function("out", "in"),
    )
    placed = _composed(read.join(_entries(read), ["file", "block"]), "file", "block", "place")
    inside = (F.coalesce("last_mark", "entry") + F.col("turns_before")) % 2
    in_block = Window.partitionBy("file", "block").orderBy("place")
    numbered = placed.withColumn("inside", inside).select(
        "file", "time", "block", "place", "line", "inside",
        F.coalesce(F.lead("inside").over(in_block), "exit").alias("goes_on"),
        # Lines before the block's first record (number 0) belong to one of an earlier block.
        F.sum(1 - F.col("inside")).over(in_block.rowsBetween(Window.unboundedPreceding, 0)).alias("number"),
        "home",
    )
    numbered = numbered.withColumn(
        "record", F.when(F.col("number") > 0, F.struct("block", "number")).otherwise(F.col("home"))
    ).withColumn("first", (F.col("record.block") == 0) & (F.col("record.number") == 1))
    alone = (F.col("inside") == 0) & (F.col("goes_on") == 0)
    several = numbered.filter(~alone).groupBy("file", "record").agg(
        F.first("time").alias("time"), F.first("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("block", "place", "line"))).alias("lines"),
    )
    return numbered.filter(alone).select("file", "time", "first", F.col("line").alias("value")).unionByName(
        several.select("file", "time", "first", F.array_join("lines.line", "\n").alias("value"))
    )


def _function(out: str, into: str) -> tuple[Column, Column]:
    """What a line does to the state: it takes both to one (`set`), or turns them round (`turn`), or changes nothing."""
    return (
        F.when(F.col(out) == F.col(into), F.col(out)).cast("long").alias("set"),
        F.when(F.col(out) > F.col(into), 1).otherwise(0).cast("long").alias("turn"),
    )


def _composed(rows: DataFrame, *keys_and_order: str) -> DataFrame:
    """With the functions of all rows before a row of its group as one: after a row that sets the state it is `set`
    and the turns since, which is `last_mark` and all turns, by parity."""
    *keys, order = keys_and_order
    window = Window.partitionBy(*keys).orderBy(order)
    until_here = window.rowsBetween(Window.unboundedPreceding, 0)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("turns", F.sum("turn").over(until_here))
    rows = rows.withColumn("mark", F.col("set").bitwiseXOR(F.col("turns") % 2))
    return rows.withColumns({
        "last_mark": F.last("mark", ignorenulls=True).over(before),
        "turns_before": F.col("turns") - F.col("turn"),
    })


def _entries(read: DataFrame) -> DataFrame:
    """For each block whether its first line begins in quotes (entry) and the line after it does (exit), and the record
    that its first line goes on with, if it does: the block it begins in and its number there (home)."""
    composed = _composed(read.drop("line", "time"), "file", "block", "place")
    starts = [1 - (F.coalesce("last_mark", F.lit(state)) + F.col("turns_before")) % 2 for state in (0, 1)]
    blocks = composed.groupBy("file", "block").agg(
        F.max_by("mark", F.when(F.col("mark").isNotNull(), F.col("place"))).alias("mark"),
        F.sum("turn").alias("turn"), F.sum(starts[0]).alias("starts_0"), F.sum(starts[1]).alias("starts_1"),
    ).select(
        "file", "block", "starts_0", "starts_1", (F.col("turn") % 2).alias("turn"),
        F.col("mark").bitwiseXOR(F.col("turn") % 2).alias("set"),
    )
    # A block that sets the state leaves it the same for both; its turns are in `set` already.
    blocks = _composed(
        blocks.withColumn("turn", F.when(F.col("set").isNull(), F.col("turn")).otherwise(0)), "file", "block"
    )
    entry = (F.coalesce("last_mark", F.lit(0)) + F.col("turns_before")) % 2
    blocks = blocks.withColumn("entry", entry)
    leaving = F.coalesce("set", (F.col("entry") + F.col("turn")) % 2)
    begun = F.when(F.col("entry") == 1, F.col("starts_1")).otherwise(F.col("starts_0"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(begun > 0, F.struct("block", begun.alias("number")))
    return blocks.withColumn("last", last).select(
        "file", "block", "entry", leaving.alias("exit"), F.last("last", ignorenulls=True).over(before).alias("home")
    )
