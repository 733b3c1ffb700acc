"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from intentmill.llm import (
    op1_secret_scan,
    op10_jaccard_join,
    op11_alignment,
    op12_collocations,
    op13_warc,
    op2_fingerprint,
    op3_quality,
    op4_token_counts,
    op5_decontamination,
    op6_packing,
    op7_substring_dedup,
    op8_toxicity,
    op9_sharding,
)
from intentmill.llm.common import table
from intentmill.llm.oracle import ORACLE_SQL
from intentmill.sources.results import shared_folder

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_secret_scan_(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = op1_secret_scan.find_secrets(docs.select("doc_id", "text"), F.col("text"))
    spans = F.filter(F.split("spans", ","), lambda s: s != "")
    kind = lambda s: F.substring_index(s, ":", 1)
    count = lambda k: F.size(F.filter("all", lambda s: kind(s) == k)).cast("long").alias(f"n_{k}")
    base = [r.kind for r in op1_secret_scan.BASE]
    return found.withColumn("all", spans).select(
        F.col("doc_id").cast("long").alias("doc_id"), *[count(k) for k in base],
        F.sha2(F.array_join(F.filter("all", lambda s: kind(s).isin(base)), ","), 256).alias("base_sha256"),
        "spans",
    )


def op2_closed_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return op2_fingerprint.fingerprint(table(spark, folder, "documents"))


def op3_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    return op3_quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_token_counts_(spark: SparkSession, folder: str) -> DataFrame:
    return op4_token_counts.count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op5_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    found = op5_decontamination.decontaminate(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.drop("text_hash")


def op6_packing_(spark: SparkSession, folder: str) -> DataFrame:
    return op6_packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_count_min(spark: SparkSession, folder: str) -> DataFrame:
    return op7_substring_dedup.digests(op7_substring_dedup.remove_repeats(table(spark, folder, "documents")))


def op8_levenshtein_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return op8_toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_resharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = op9_sharding.reshard(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_t_occurrence(spark: SparkSession, folder: str) -> DataFrame:
    found = op10_jaccard_join.jaccard_components(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_fragment_monoid(spark: SparkSession, folder: str) -> DataFrame:
    return op11_alignment.align(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op12_best_first_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return op12_collocations.collocations(table(spark, folder, "documents"))


def op13_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    op13_warc.write_archives(table(spark, folder, "pages"), path)
    return op13_warc.read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES = {
    "op1_secret_scan": op1_secret_scan_,
    "op2_closed_syncmers": op2_closed_syncmers,
    "op3_attention_quality": op3_attention_quality,
    "op4_token_counts": op4_token_counts_,
    "op5_winnowing": op5_winnowing,
    "op6_packing": op6_packing_,
    "op7_count_min": op7_count_min,
    "op8_levenshtein_toxicity": op8_levenshtein_toxicity,
    "op9_resharding": op9_resharding,
    "op10_t_occurrence": op10_t_occurrence,
    "op11_fragment_monoid": op11_fragment_monoid,
    "op12_best_first_phrases": op12_best_first_phrases,
    "op13_warc_archive": op13_warc_archive,
    "pipeline": corpus_pipeline.run,
}
