"""The corpus operators as queries over the driver's tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import bpe, language, negatives, ordinal, packing, pieces, pii, secrets, simhash, syncmers, topk, toxicity, variants

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
ACCEPT = 0.5


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


@query
def op4_simhash_components(spark, d):
    found = simhash.near_duplicate_components(documents(spark, d))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_sentencepiece(spark, d):
    return pieces.piece_digests(documents(spark, d), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op10_language_rank(spark, d):
    docs = documents(spark, d)
    out = language.held_out()
    profiles = language.learn(docs.filter(~out))
    return language.predict(docs, profiles).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op1_quality_ordinal(spark, d):
    """Expected grade and P(quality >= 1) of every document; ``accepted`` is what the pipeline keeps."""
    docs = documents(spark, d)
    model = ordinal.learn(docs, spark.read.parquet(f"{d}/labels.parquet"))
    return ordinal.score(docs, model).withColumn("accepted", F.col("tail_probability") >= ACCEPT)


@query
def op7_toxicity_fm(spark, d):
    docs = documents(spark, d)
    out = language.held_out()
    labels = spark.read.parquet(f"{d}/labels.parquet").filter(~out)
    model = toxicity.learn(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op3_grouping_packing(spark, d):
    return packing.packed_documents(documents(spark, d), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_exact_topk(spark, d):
    vectors = spark.read.parquet(f"{d}/embeddings.parquet")
    return topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0)


ORACLE["op6_exact_topk"] = """
WITH usable AS (
  SELECT row_number() OVER () AS number, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.number, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY number ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op5_crf_pii(spark, d):
    docs = documents(spark, d)
    return pii.find(docs, pii.learn(docs))


@query
def op2_syncmer_fingerprints(spark, d):
    return syncmers.edited_fingerprints(documents(spark, d))


@query
def op9_entropy_secrets(spark, d):
    return secrets.find(documents(spark, d))


@query
def op11_spelling_variants(spark, d):
    return variants.variant_forms(variants.counted_words(documents(spark, d)))


@query
def op12_bpe_backtracking(spark, d):
    rows = bpe.encode(documents(spark, d), public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op13_hard_negatives(spark, d):
    return negatives.hard_negatives(negatives.noisy_labels(spark.read.parquet(f"{d}/embeddings.parquet")), F.col("vec_id") % 100 == 0)


ORACLE["op13_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same,
    CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
