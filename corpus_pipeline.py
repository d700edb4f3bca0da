"""The corpus pipeline: documents through toxicity, near duplicates, repeated passages, benchmark leaks
and packing. Each stage takes what the one before has written and, but for the last, returns the columns of
documents, those of other names that come with them included.

A null text counts as an empty one and stays null until its text is cut; rows without an id and rows that repeat one are
documents of their own; an empty table stays empty. Texts are never cut to a length, only by the passages they repeat."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reddwatch.llm import decontamination, packing, repeats, simhash, toxicity
from reddwatch.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that score 0.3 or more. Without toxic labels nothing goes."""
    return toxicity.kept(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest doc_id."""
    return simhash.representatives(docs, words=3, distance=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of documents with smaller ids; a text may become empty."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    found = repeats.removed(docs, carry=others, keep=True)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept")}
    return found.select(*(
        new.get(c, F.col("carried").getField(c) if c in others else None).cast(docs.schema[c].dataType).alias(c)
        for c in docs.columns
    ))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item. Items without words are in no document."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 1024 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
ORACLE_SQL = None  # models, fingerprints and tokens have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the whole documents table; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
