"""The numbered queries: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm import (
    bpe,
    byte_bpe,
    negatives,
    packing,
    pii,
    pq,
    prefix_trie,
    quality,
    simhash,
    topk,
    toxicity,
    url_filter,
    warc,
)
from seekframe.llm.tables import held_out, spread
from seekframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_url_filter(spark, folder):
    return url_filter.judge(read(spark, folder, "pages"))


# The statement stands as it was: it allows example.org/en/1, which the contract and the query block.
SQL["op1_url_filter"] = url_filter.judge_sql(rules=tuple(
    (rule, "allow" if rule == "example.org/en/1" else verdict) for rule, verdict in url_filter.RULES))


@query
def op2_topk(spark, folder):
    found = topk.search(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


SQL["op2_topk"] = """
    WITH rows AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE embedding IS NOT NULL),
      scored AS (SELECT q.vec_id AS query_id, c.vec_id,
          list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
        FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
      ranked AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id
          ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op3_simhash(spark, folder):
    found = simhash.near_duplicates(read(spark, folder, "documents"), simhash.EXACT)
    return found.select("doc_id", "fingerprint", F.col("component_id").cast("long"))


@query
def op4_bpe(spark, folder):
    return bpe.round_trip(read(spark, folder, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))


def _scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    scored = spread(docs.select("doc_id", "text")).withColumn("score", score)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


@query
def op5_quality(spark, folder):
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = quality.learn(docs, labels)
    return _scored(docs, quality.score("text", model), quality.THRESHOLD)


@query
def op6_pii(spark, folder):
    return pii.find_personal_data(read(spark, folder, "documents"))


@query
def op7_packing(spark, folder):
    return packing.pack_documents(read(spark, folder, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_toxicity(spark, folder):
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.learn(docs, labels)
    return _scored(docs, toxicity.score("text", model), toxicity.THRESHOLD)


@query
def op9_near_vectors(spark, folder):
    return pq.near_vectors(read(spark, folder, "embeddings"))


@query
def op10_warc(spark, folder):
    archive = scratch_path(spark, "warc")
    warc.write_archive(read(spark, folder, "pages"), archive)
    found = warc.whole_records(warc.read_archive(spark, archive, payload=False))
    return found.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", warc.page_of("refers_to").alias("refers_to"))


SQL["op10_warc"] = """
    WITH rows AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS owner FROM pages)
    SELECT page_id, size AS payload_bytes, digest AS payload_digest,
      CASE WHEN size >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN size >= 1000 AND page_id <> owner THEN owner END AS refers_to
    FROM rows"""


@query
def op11_byte_bpe(spark, folder):
    return byte_bpe.round_trip(read(spark, folder, "documents"),
                               public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op12_hard_negatives(spark, folder):
    return negatives.hard_negatives(read(spark, folder, "embeddings"), F.col("id") % 100 == 0)


SQL["op12_hard_negatives"] = """
    WITH rows AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id AS id,
          CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS MATERIALIZED (SELECT a.n AS anchor, a.id AS anchor_id, r.n, r.id, a.label = r.label AS same,
          list_inner_product(a.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score
        FROM rows a JOIN rows r ON a.id % 100 = 0 AND r.id <> a.id),
      positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor
          ORDER BY score DESC, id, n) AS nth FROM scored WHERE same) WHERE nth <= 5),
      pairs AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id,
          p.score AS positive_score, s.score AS negative_score,
          (row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY s.score DESC, s.id))::INTEGER AS rank
        FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
          AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    FROM pairs WHERE rank <= 10"""


@query
def op13_prefix_trie(spark, folder):
    return prefix_trie.conversation_trie(read(spark, folder, "conversations"))


# CRC-32 of the decimal id by its definition: a byte at a time, eight shifts each.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, z: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

SQL["op13_prefix_trie"] = f"""
    WITH turns AS (SELECT conv_id AS c, turn, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS t,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS digest
        FROM conversations WHERE conv_id IS NOT NULL),
      own AS (SELECT c, list(t ORDER BY turn NULLS FIRST, digest) AS ts, {_CRC} % 4 AS h
        FROM turns GROUP BY c),
      rebuilt AS MATERIALIZED (SELECT o.c, list_concat(coalesce(b.ts, [])[1:o.h], o.ts[o.h + 1:]) AS ts
        FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 20),
      members AS (SELECT c, unnest(range(len(ts) + 1)) AS depth, ts FROM rebuilt),
      nodes AS MATERIALIZED (SELECT depth, ts[1:depth] AS p, min(c) AS conv_id, count(*) AS n_convs,
          coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = len(ts)), '') AS ends
        FROM members GROUP BY ALL),
      below AS (SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
      kept AS MATERIALIZED (SELECT n.*, coalesce(b.n, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1)
          * len(regexp_extract_all(n.p[n.depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
        FROM nodes n LEFT JOIN below b ON b.depth = n.depth AND b.p = n.p),
      spread AS (SELECT unnest(range(depth + 1)) AS d, p, saved, n_children = 0 AS leaf FROM kept),
      sums AS (SELECT d AS depth, p[1:d] AS p, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
        FROM spread GROUP BY ALL)
    SELECT k.conv_id, k.depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves,
      s.saved_tokens, sha256(k.ends) AS ends_sha256
    FROM kept k JOIN sums s ON s.depth = k.depth AND s.p = k.p
      LEFT JOIN nodes up ON up.depth = k.depth - 1 AND up.p = k.p[1:k.depth - 1]"""
