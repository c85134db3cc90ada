"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from faremill.llm import bpe, centroids, decontaminate, filter_audit, langid, linededup, minhash, neighbours, pii, secrets, sharding, token_files, toxicity
from faremill.llm.common import fewer_tasks, held_out, table


def vocabulary(name: str) -> str:
    """The text of a public tokenizer's file."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_context_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(pii.digest(table(spark, sf_dir, "documents")))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = langid.predict(docs.select("doc_id", "text"), langid.learn(docs))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, num=85, den=100)
    return fewer_tasks(found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = linededup.remove_lines(docs, drop_emptied=False, count_into=("n_lines", "n_removed"), short=True)
    return left.select("doc_id", "n_lines", "n_removed", F.octet_length("text").cast("bigint").alias("kept_bytes"), F.sha2("text", 256).alias("kept_sha256"))


def op7_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op9_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(neighbours.search(table(spark, sf_dir, "embeddings"), k=20, every=20))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(centroids.cluster(table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, length=64))


def op12_assigned_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fewer_tasks(filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_context_pii, op2_token_files, op3_language_mixture, op4_minhash, op5_bpe, op6_line_dedup, op7_rendezvous_sharding, op8_toxicity, op9_kmeans_tree, op10_spaced_seeds, op11_orchard_clusters, op12_assigned_secrets, op13_filter_audit)}
ORACLES: dict[str, str] = {"op11_orchard_clusters": centroids.cluster_sql(), "op13_filter_audit": filter_audit.audit_sql()}
