"""The registered queries of this package: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import alignment, exact, neighbours, packing, pii, pow2, repeats, simhash, tokens, toxicity, warc, whitening
from changeflow.llm.common import ship, table, workspace

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), path, with_ids=False)
    return placed.withColumnRenamed("id", "doc_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = tokens.token_counts(table(spark, sf_dir, "documents"), path)
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit")
    )


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = tokens.encoded_texts(table(spark, sf_dir, "documents"), path, full=False)
    return done.withColumnRenamed("id", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(count(kind) for kind in pii.KINDS),
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return done.withColumnRenamed("id", "doc_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs, labels, ~toxicity.held_out(F.col("id")), with_evidence=False)
    return scored.select(
        F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score", "predicted"
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"), largest=True)
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op11_spectral_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_pow2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = pow2.decomposed(table(spark, sf_dir, "documents"), path, with_ids=False)
    return pieces.drop("bucket").withColumnRenamed("id", "doc_id")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths).withColumnRenamed("id", "doc_id")


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_best_fit_packing,
        op2_token_counts,
        op3_bpe_codec,
        op4_warc,
        op5_pii,
        op6_nn_descent,
        op7_suffix_array_dedup,
        op8_toxicity,
        op9_exact_dedup,
        op10_simhash,
        op11_spectral_whitening,
        op12_pow2_packing,
        op13_token_alignment,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
        WITH sized AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT payload_digest AS d, min(page_id) AS first_id FROM sized WHERE payload_bytes >= 100 GROUP BY 1
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM sized LEFT JOIN firsts ON payload_digest = d AND payload_bytes >= 100
    """,
    # All pairs, as the definition has it; the operator's search is approximate.
    "op6_nn_descent": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
              ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
        ), reached AS (
            SELECT vec_id, vec_id AS root FROM embeddings
            UNION
            SELECT b, root FROM reached JOIN links ON a = vec_id
        ), lowest AS (SELECT vec_id, min(root) AS component_id FROM reached GROUP BY 1),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM lowest LEFT JOIN degree ON a = vec_id
    """,
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
