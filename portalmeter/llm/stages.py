"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next.

In every stage nulls, empty and very long texts, ties, repeated rows, empty tables and further columns are handled
as the operator it calls says. Columns other than those a stage changes go through as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portalmeter.llm.containment import contained_items
from portalmeter.llm.dart_minhash import near_duplicate_classes
from portalmeter.llm.quality_rules import THRESHOLD, learn_quality, with_statistics
from portalmeter.llm.source_mix import mix_sources, taken_words
from portalmeter.llm.substring_dedup import remove_repeats
from portalmeter.llm.words import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, so that no name clashes with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the rules accept; they are learnt from those of ``docs`` that have labels."""
    model = learn_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = with_statistics(docs.select(whole_row(docs), "text"))
    # Beside a number of the row the score is worked out once: Spark would else move the condition below the
    # statistics and repeat them for every rule.
    judged = scored.select("row", model.score().alias("score"), F.monotonically_increasing_id().alias("number"))
    return judged.where((F.col("score") >= THRESHOLD) & (F.col("number") >= 0)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, that of the smallest doc_id; texts without words stay."""
    has_words = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    kept = near_duplicate_classes(docs, Scratch(spark)).where("is_kept").select(F.col("doc_id").alias("d"), F.col("node").alias("k"))
    worded = docs.where(has_words).select(whole_row(docs), "doc_id", F.unhex(F.md5("text")).alias("node"))
    joined = worded.join(kept, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("node") == F.col("k")))
    # Repeated rows meet here; they are alike, but for other columns perhaps.
    first = F.row_number().over(Window.partitionBy("d", "k").orderBy(F.xxhash64("row")))
    return joined.withColumn("n", first).where("n = 1").select("row.*").union(docs.where(~has_words))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 20 words or more that stand earlier in the documents; n_chars follows the text."""
    kept = remove_repeats(docs, keep_gaps=True).select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "kept_text")
    text = F.col("text")
    rest = docs.select(whole_row(docs.drop("text")), "doc_id", text.isNull().alias("none"), F.md5(F.coalesce(text, F.lit(""))).alias("mark"))
    joined = rest.join(kept, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")))
    new = F.when(~F.col("none"), F.col("kept_text"))
    values = {"text": new, "n_chars": F.length(new).cast("long")}
    return joined.select(*[values[c].alias(c) if c in values else F.col("row").getField(c).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of ``benchmark``; rows of one doc_id go together."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    leaked = contained_items(docs.select("doc_id", "text"), items, Scratch(spark)).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(F.col("leaked_id")), "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source_size, target, taken."""
    return taken_words(mix_sources(docs.select("doc_id", "text", "source"), Scratch(spark)))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

# Hashed signatures, learnt rules and hypergeometric draws are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if number > 0:
            scratch.drop(STAGES[number - 1][0])
    return docs
