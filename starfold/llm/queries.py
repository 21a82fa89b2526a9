"""One query for each operator of this subpackage, applied to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfold.llm import (
    bloom_lookup, cap_filters, decontaminate, importance, language, licenses, mixing, order_minhash, preferences,
    secret_spans, token_overlaps, token_trees, toxicity,
)
from starfold.llm.common import documents, learnt_from


def preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with the next one's last answer: prompt, completions and masks."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = preferences.swapped_answers(preferences.conversations(turns))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        "-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(c)
    return preferences.format_preferences(pairs).select(
        F.col("pair_id").alias("conv_id"), "n_common", "prompt", "chosen", "rejected", spans("chosen_mask"),
        spans("rejected_mask"),
    )


def license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def bloom_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lookup.fingerprint_versions(documents(spark, sf_dir))


def order_minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(documents(spark, sf_dir))


def edit_aware_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_trees.count_edited(documents(spark, sf_dir))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(documents(spark, sf_dir)).taken()


def structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans.scan_digests(documents(spark, sf_dir))


def subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(learnt_from("doc_id"))
    model = toxicity.fit(docs, labels)
    held_out = ~learnt_from("doc_id")
    return toxicity.rate(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def word_backoff_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs.filter(learnt_from("doc_id")), "doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (~learnt_from("doc_id")).alias("held_out"), "lang_pred", "score")


def pigeonhole_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), items)


def cap_filter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_overlaps.compare_tokenizers(documents(spark, sf_dir), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES = {
    "op1_preference_format": preference_format,
    "op2_license_compression": license_compression,
    "op3_bloom_fingerprint": bloom_fingerprint,
    "op4_order_minhash": order_minhash_classes,
    "op5_edit_aware_tokens": edit_aware_tokens,
    "op6_source_mix": source_mix,
    "op7_structural_secrets": structural_secrets,
    "op8_subword_toxicity": subword_toxicity,
    "op9_word_backoff_language": word_backoff_language,
    "op10_pigeonhole_leaks": pigeonhole_leaks,
    "op11_cap_filters": cap_filter_links,
    "op12_importance_resample": importance_resample,
    "op13_token_alignment": token_alignment,
}
