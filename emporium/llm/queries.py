"""Registered queries of the training-data operators: each applies its
operator to the whole of its table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import bag_minhash, bpe_trie, decontaminate, hilbert_search, html_crf, license_scan, ns_kmeans, paragraph_dedup, quality_fm, secret_scan, source_divergence, url_lists, vector_join
from emporium.llm.common import table


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model).select(
        "doc_id", quality_fm.is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.query(spark, table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated(spark, table(spark, sf_dir, "documents"))


def op8_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op10_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_ns_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ns_kmeans.cluster_vectors(spark, table(spark, sf_dir, "embeddings"))


def op12_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_search.search(spark, table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_fm": op1_quality_fm,
    "op2_decontaminate": op2_decontaminate,
    "op3_bag_minhash": op3_bag_minhash,
    "op4_license_scan": op4_license_scan,
    "op5_url_lists": op5_url_lists,
    "op6_secret_scan": op6_secret_scan,
    "op7_paragraph_dedup": op7_paragraph_dedup,
    "op8_html_crf": op8_html_crf,
    "op9_vector_join": op9_vector_join,
    "op10_bpe_trie": op10_bpe_trie,
    "op11_ns_kmeans": op11_ns_kmeans,
    "op12_hilbert_search": op12_hilbert_search,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op5_url_lists": url_lists.SQL,
    "op11_ns_kmeans": ns_kmeans.SQL,
    "op13_source_divergence": source_divergence.SQL,
}
