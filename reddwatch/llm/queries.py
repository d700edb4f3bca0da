"""The registered queries of the numbered operators: each on its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reddwatch.llm import (
    covertree, decontamination, html, licenses, maxscore, packing, pieces, repeats, simhash, tokens, toxicity, trie, warc,
)
from reddwatch.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokens.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), limit=512
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.matches(table(spark, sf_dir, "documents"))


def op7_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every fiftieth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.search(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extracted(table(spark, sf_dir, "pages"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without passages of earlier ones."""
    return repeats.removed(table(spark, sf_dir, "documents")).drop("spans")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as the archives hold it."""
    return warc.archived(table(spark, sf_dir, "pages"), least=0).drop("url")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix tree of the regrown conversations."""
    return trie.nodes(trie.regrown(trie.sequences(table(spark, sf_dir, "conversations"))))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to."""
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), from_files=True)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the five nearest positives of every hundredth vector; labels of every seventh are moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return covertree.hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash, op2_toxicity, op3_packing, op4_token_counts, op5_decontamination, op6_licenses, op7_maxscore,
        op8_html, op9_repeats, op10_warc, op11_prefix_trie, op12_pieces, op13_hard_negatives,
    )
}

ORACLE: dict[str, str] = {
    "op5_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents
        ), b AS (
            SELECT item_id, text, ws, least(len(ws), 5) AS k
            FROM (SELECT DISTINCT item_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM benchmark)
            WHERE len(ws) > 0
        ), bs AS (
            SELECT DISTINCT item_id, text, k, array_to_string(ws[i : i + k - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM b)
        ), ds AS (
            SELECT DISTINCT doc_id, k, array_to_string(ws[i : i + k - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b))
        ), n AS (
            SELECT item_id, text, k, count(*) AS n FROM bs GROUP BY ALL
        )
        SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_shingles, CAST(count(*) AS INTEGER) AS n_shared,
               CAST(count(*) AS DOUBLE) / n AS containment
        FROM bs JOIN ds USING (k, s) JOIN n USING (item_id, text, k)
        GROUP BY doc_id, item_id, text, n
        HAVING count(*) >= ceil(n * 0.8 - 1e-9)
    """,
    "op7_maxscore": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), h AS (
            SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM p
        ), m AS (
            SELECT hex, payload_bytes, max(page_id) AS largest FROM h GROUP BY ALL
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER),
                   1)), '') AS payload_digest,
               CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> largest THEN largest END AS refers_to
        FROM h JOIN m USING (hex, payload_bytes)
    """,
    "op11_prefix_trie": """
        WITH t AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS own
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), h AS (
            SELECT conv_id, own, CAST(xor(list_reduce(
                [4294967295] || list_transform(range(1, len(CAST(conv_id AS VARCHAR)) + 1), lambda i: ord(CAST(conv_id AS VARCHAR)[i])),
                lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
                    lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))
            ), 4294967295) AS BIGINT) % 9 AS h FROM t
        ), r AS (
            SELECT h.conv_id, coalesce(t.own[1 : h.h], []) || h.own[h.h + 1 :] AS turns
            FROM h LEFT JOIN t ON t.conv_id = h.conv_id - h.conv_id % 5
        ), p AS (
            SELECT conv_id, len(turns) AS n_turns, depth, turns[1 : depth] AS prefix
            FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM r)
        ), n AS (
            SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n_turns = depth), '')) AS ends_sha256,
                   CASE WHEN depth > 0 THEN (count(*) - 1) * octet_length(encode(prefix[depth].text)) ELSE 0 END AS saved
            FROM p GROUP BY depth, prefix
        ), c AS (
            SELECT depth - 1 AS depth, prefix[1 : depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
        ), m AS (
            SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM n LEFT JOIN c USING (depth, prefix)
        ), s AS (
            SELECT above AS depth, prefix[1 : above] AS prefix, sum(saved) AS saved_tokens,
                   count(*) FILTER (n_children = 0) AS n_leaves
            FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM m) GROUP BY ALL
        )
        SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
               CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
        FROM m JOIN s USING (depth, prefix)
        LEFT JOIN n AS u ON u.depth = m.depth - 1 AND u.prefix = m.prefix[1 : m.depth - 1]
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
                   CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
            FROM v AS a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
    """,
}
