"""Benchmark items inside documents, by size-partitioned MinHash containment search.

An item is a set of word shingles. Its sketch are the k least of their hash values, with k set by the size
partition it is in: of n shingles at most n - ceil(t n) may be missing from a document that contains it
to the share t, so of one more minima at least one is there, and no such document is overlooked. Documents are
probed whole: all their shingles are looked up among the sketches, and what has one is compared shingle by shingle.
Everything is DataFrame functions. Items with equal texts are looked for once and get their ids at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import documents, picked, written
from reddwatch.operators.joins import BROADCAST_BYTES

# Up to so many pairs of minimum and item the minima are put into the scan of the documents as a constant and the pairs
# are broadcast (40 bytes each); more are joined.
INLINE = 20_000
# Where a side is too large for a broadcast, a key's rows are dealt over so many parts.
PARTS = 32


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """With a column that is computed once for each row, however often it is used: what is used within
    a lambda would else be computed anew for each element."""
    return df.withColumn(name, F.explode(F.array(value)))


def _starts(found: Column, size: int) -> Column:
    return F.when(F.size(found) >= size, F.sequence(F.lit(0), F.size(found) - size)).otherwise(
        F.array().cast("array<int>")
    )


def hashes(found: Column, size: int) -> Column:
    """One hash value for each shingle of `size` words, in their order."""
    return F.transform(_starts(found, size), lambda i: F.xxhash64(*(F.get(found, i + j) for j in range(size))))


def shingles(found: Column, size: int) -> Column:
    return F.transform(_starts(found, size), lambda i: F.array_join(F.slice(found, i + 1, size), " "))


def sketches(texts: DataFrame, size: int, share: float) -> DataFrame:
    """Of each text its item (a hash of the text), length (words of a shingle), its shingles, how many a document
    must hold, and the sketch: the k least hash values, k by the size partition (a power of two)."""
    items = once(texts, "words", words(F.col("text"))).filter(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(size)))
    by_length = lambda f: F.coalesce(*(F.when(F.col("length") == n, f(F.col("words"), n)) for n in range(1, size + 1)))
    items = items.select(
        key(F.col("text")).alias("item"), "length",
        F.array_distinct(by_length(shingles)).alias("shingles"),
        F.array_sort(F.array_distinct(by_length(hashes))).alias("values"),
    )
    least = F.ceil(F.size("shingles") * F.lit(share) - 1e-9).cast("int")
    # The partition of sizes up to 2^c: as many minima as its largest items need, all at most.
    partition = F.ceil(F.log2(F.size("shingles"))).cast("int")
    top = F.pow(F.lit(2), F.col("partition"))
    return (
        items.withColumn("needed", F.greatest(least, F.lit(1)))
        .withColumn("partition", partition)
        .withColumn("sketch", F.slice("values", 1, (F.floor(top * F.lit(1 - share) + 1e-9) + 1).cast("int")))
        .drop("values")
    )


def key(*columns: Column) -> Column:
    """32 bytes that stand for a row's values."""
    return F.unhex(F.sha2(F.to_json(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(columns)))), 256))


def dealt(left: DataFrame, right: DataFrame, on: str, by: str) -> DataFrame:
    """Join on a key; each key's left rows are dealt over PARTS tasks by the hash of a column, to each of which its
    right rows go, so a task that runs again deals them alike."""
    part = F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    return left.withColumn("part", part).join(right.withColumn("part", every), [on, "part"]).drop("part")


def matches(
    docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text", inline: int = INLINE, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment for each row of docs and item of which the row
    holds at least `share` of the distinct shingles of `size` words.

    An item of fewer words is one shingle of all its words. Items and documents without a word match nothing. Null
    texts count as empty; null ids stay null. Repeated rows of docs are reported each, repeated rows of the
    benchmark once. Further columns are ignored; an empty table on either side gives no rows.

    Minima are looked up within the scan if they make at most `inline` rows, and items' shingles and ids are broadcast
    if they are counted at most `broadcast_bytes` each. Beyond these bounds they are joined, with the same rows.
    """
    texts = documents(docs, id_col, text_col)
    named = picked(benchmark, item_id=("item_id", "long"), text=("text", "string")).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    items = written(sketches(named.select("text").distinct(), size, share), "decontamination-items")
    names = written(named.select("item_id", key(F.col("text")).alias("item")).distinct(), "decontamination-names")
    bounds = items.agg(
        F.collect_set("length").alias("lengths"),  # at most `size` numbers
        F.sum(F.size("sketch")).alias("rows"),
        F.sum(F.aggregate("shingles", F.lit(0).cast("long"), lambda n, s: n + F.octet_length(s) + 16)).alias("bytes"),
    ).first()
    lengths = sorted(bounds["lengths"]) or [size]
    index = items.select("item", F.explode("sketch").alias("value"))
    values = lambda found: F.concat(*(hashes(found, n) for n in lengths))
    if (bounds["rows"] or 0) <= inline:
        # Few: looked up where the document is read, so nothing is shuffled.
        minima = [r[0] for r in index.select("value").distinct().collect()]  # at most `inline` numbers
        constant = F.from_json(F.lit("[" + ",".join(map(str, minima)) + "]"), "array<long>")
        own = once(texts, "words", words(F.col("text"))).drop("text")
        hits = once(own, "hits", F.array_intersect(values(F.col("words")), constant)).filter(F.size("hits") > 0)
        pairs = hits.withColumn("value", F.explode("hits")).join(F.broadcast(index), "value")
    else:
        # Documents are known by their content, so a step that runs again gives them the same names.
        own = texts.withColumn("row", key(F.col("doc_id"), F.col("text")))
        found = once(own, "words", words(F.col("text"))).select(
            "row", F.explode(F.array_distinct(values(F.col("words")))).alias("value")
        )
        found = dealt(found, index.select("value").distinct(), "value", "row")
        found = found.groupBy("row").agg(F.collect_set("value").alias("hits"))
        own = once(own.join(found, "row"), "words", words(F.col("text"))).drop("text", "row")
        pairs = dealt(own.withColumn("value", F.explode("hits")), index, "value", "doc_id")
    # A pair is found for each minimum in common; one of them is enough.
    if (bounds["bytes"] or 0) <= broadcast_bytes:
        pairs = pairs.join(F.broadcast(items), "item")
    else:
        pairs = dealt(pairs, items, "item", "doc_id")
    pairs = pairs.filter(F.col("value") == F.array_min(F.array_intersect("hits", "sketch")))
    held = F.coalesce(*(F.when(F.col("length") == n, shingles(F.col("words"), n)) for n in lengths))
    shared = F.size(F.array_intersect("shingles", held))
    matched = pairs.withColumn("n_shared", shared).filter("n_shared >= needed").select(
        "doc_id", "item", F.size("shingles").alias("n_shingles"), "n_shared"
    )
    if names.count() * 48 <= broadcast_bytes:
        matched = matched.join(F.broadcast(names), "item")
    else:
        matched = dealt(matched, names, "item", "doc_id")
    return matched.select(
        "doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of docs, with all their columns, whose id is not that of a row that holds an item."""
    held = matches(docs, benchmark, size, share, id_col, text_col).select("doc_id").distinct()
    return docs.join(held, docs[f"`{id_col}`"].cast("long").eqNullSafe(held["doc_id"]), "left_anti")
