"""Queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    contamination,
    divergence,
    embeddings,
    filter_audit,
    host_rules,
    html,
    language,
    licences,
    ngram_lm,
    packing,
    quality,
    simhash,
    urls,
)
from tideline.llm.frames import remainder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang", (remainder("doc_id", 4) == 2).alias("held_out"))
    model = language.train(docs.where("NOT held_out"))
    named = language.identify(docs.drop("lang"), model)
    return named.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_ambiguous").alias("ambiguous"))


def op3_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(_table(spark, folder, "pages"))


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_table(spark, folder, "pages"))


def op5_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.find(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.recognise(_table(spark, folder, "documents"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", quality.held_out().alias("held_out"))
    model = quality.train(docs, _table(spark, folder, "labels").where(~quality.held_out()))
    scored = quality.assess(docs, model).withColumnRenamed("quality_score", "score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 7) == 2
    scored = ngram_lm.score(docs, *ngram_lm.train(docs.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op10_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


def op12_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = host_rules.judge(_table(spark, folder, "documents").select("doc_id", "source", "text"))
    measures = [f"measures.{m}" for m in host_rules.MEASURES if m != "n_lines"]
    return judged.select("doc_id", *measures, F.array_contains("failed", "base").alias("base_failed"), "host_rejected", "kept")


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_language,
        op3_urls,
        op4_html,
        op5_contamination,
        op6_licences,
        op7_quality,
        op8_ngram_lm,
        op9_packing,
        op10_embeddings,
        op11_divergence,
        op12_host_rules,
        op13_filter_audit,
    )
}

SQL = {
    "op3_urls": urls.oracle(),
    "op5_contamination": contamination.oracle(),
    "op6_licences": licences.oracle(),
    "op11_divergence": divergence.oracle(),
    "op12_host_rules": host_rules.oracle(),
    "op13_filter_audit": filter_audit.oracle(),
}
