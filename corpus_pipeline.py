"""From raw documents to packed training sequences; each stage works on what the one before has kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import contamination, language, packing, quality, simhash
from tideline.llm.frames import plain_names
from tideline.session import stage


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row that is the same in every later use: ids may be null or repeat.

    Rows of files have one by their place: the hash of the file's name, changed by the row's index in it.  Two rows only share one if
    the names of their files agree in all bits above the index.  Other rows are numbered and written.
    """
    try:
        return docs.withColumn("row", F.xxhash64("_metadata.file_path").bitwiseXOR(F.col("_metadata.row_index")))
    except AnalysisException:
        return stage(docs.withColumn("row", F.monotonically_increasing_id()), "rows")


def _without(rows: DataFrame, dropped: DataFrame, names: list[str]) -> DataFrame:
    return rows.join(dropped, "row", "left_anti").drop("row").toDF(*names)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Documents without a letter, and those whose language is ambiguous, go; the model learns from all that have a language.

    A null text has no letter.  Each row is judged for itself.
    """
    rows, (text,) = plain_names(docs, "text")
    named = language.identify(rows, language.train(docs), text_col=text)
    named = named.where((F.col("lang_pred") != language.UNKNOWN) & ~F.col("lang_ambiguous"))
    return named.select(*rows.columns).toDF(*docs.columns)


def line_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 go; the model learns from the labelled ones among ``docs``.  Each row is judged for itself."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.select(F.col("doc_id").try_cast(docs.schema["doc_id"].dataType).alias("doc_id"), "quality")
    rows, (text,) = plain_names(docs, "text")
    scored = quality.assess(rows, quality.train(docs, labels), text_col=text)
    return scored.where(F.col("quality_score") >= 0.3).select(*rows.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Of each group of near copies the row with the smallest id stays, of equal ids one of them, a null id last.

    Near copies are texts whose SimHash fingerprints link, as in ``op1_simhash``.  Rows that repeat are copies like any
    other, also with one id.  Texts without a word are copies of each other.
    """
    rows, (key, text) = plain_names(docs, "doc_id", "text")
    rows = _numbered(rows)
    group = stage(simhash.near_duplicates(rows, id_col="row", text_col=text).select("row", "component_id"), "near")
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("id"), "row")
    best = group.join(rows.select("row", key), "row").groupBy("component_id").agg(F.min(order)["row"].alias("row"))
    dropped = stage(group.select("row").join(best, "row", "left_anti"), "copies")
    return _without(rows, dropped, docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain a passage of the benchmark go, whatever their id; others with the same id stay."""
    rows, (text,) = plain_names(docs, "text")
    rows = _numbered(rows)
    found = contamination.find(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="row", text_col=text, item_text_col="text")
    return _without(rows, stage(found.select("row").distinct(), "leaks"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """The pieces of the sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_quality", line_quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]
ORACLE_SQL = None
"""A trained model's scores and the fill of the windows have no SQL; tests check each stage by brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, function) in enumerate(STAGES):
        out = function(spark, out, sf_dir)
        if k + 1 < len(STAGES):
            out = stage(out, name)
    return out
