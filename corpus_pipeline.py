"""From documents to mixed training blocks in five stages, each of which reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfold.llm import decontaminate, language, mixing, order_minhash, secret_spans
from starfold.llm.common import learnt_from, small_side, stored

# A text whose language has less than this share of the evidence is rejected.
LEAST_SCORE = 0.5

# The last stage cannot be told in SQL, nor can alignments or trained models.
ORACLE_SQL = None


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is determined; the model learns from the stage's own documents."""
    model = language.fit(docs.filter(learnt_from("doc_id")), "doc_id", "text", "lang")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("own_text"))
    judged = language.identify(rows, model, "own_text")
    kept = judged.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least id; nulls count as the largest.

    Where ids are null or repeat, rows are numbered in a copy of the table, and of equal ids the first row stays.
    """
    odd = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if odd.isEmpty():
        classes = stored(order_minhash.near_duplicates(docs), "classes")
        gone = classes.filter("doc_id != class_id").select("doc_id")
        return docs.join(small_side(gone), "doc_id", "left_anti").select(*docs.columns)
    whole = F.struct(*docs.columns).alias("doc")
    numbered = stored(docs.select(whole, F.monotonically_increasing_id().alias("row")), "rows")
    rows = numbered.select("row", "doc.text", "doc.doc_id")
    classes = order_minhash.near_duplicates(rows, "row").join(rows.select("row", "doc_id"), "row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = stored(classes.groupBy("class_id").agg(F.min_by("row", order).alias("row")).select("row"), "kept")
    return numbered.join(kept, "row", "left_semi").select("doc.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_items(docs, items)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and n_chars counted anew where there were any."""
    return secret_spans.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed blocks: shard, slot, source, epoch, block, n_words and text."""
    return mixing.Mix(docs).shards()


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
