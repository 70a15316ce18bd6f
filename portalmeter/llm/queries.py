"""One query per operator of this subpackage, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalmeter.llm.ball_tree import top_inner_products
from portalmeter.llm.containment import contained_items
from portalmeter.llm.conversation_repair import SUMMARY, damaged, repair_conversations, text_digests
from portalmeter.llm.dart_minhash import near_duplicate_classes
from portalmeter.llm.dom_marginals import extract_main_text
from portalmeter.llm.edit_counts import count_tokens, derived_edits
from portalmeter.llm.fill_in_middle import fill_in_middle, restored
from portalmeter.llm.gated_lm import lm_scores
from portalmeter.llm.quality_rules import learn_quality, score_quality, with_statistics
from portalmeter.llm.source_mix import mix_sources, taken_words
from portalmeter.llm.stages import run
from portalmeter.llm.substring_dedup import digest, remove_repeats
from portalmeter.llm.toxic_spans import learn_toxicity, score_toxicity
from portalmeter.llm.url_templates import judge_urls
from portalmeter.llm.words import Scratch

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark))
    return classes.select("doc_id", "class_id", "class_size", "is_kept")


@query
def op2_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(mix_sources(table(spark, sf_dir, "documents"), Scratch(spark)))


@query
def op4_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contained_items(docs, items, Scratch(spark))


@query
def op5_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    edited = docs.withColumn("edits", derived_edits(F.coalesce("text", F.lit("")), F.col("doc_id")))
    return count_tokens(edited).drop("leaf_tokens")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", digest(F.col("kept_text")).alias("kept_sha256"))


@query
def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), Scratch(spark))


@query
def op8_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), Scratch(spark))


@query
def op9_dom_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(with_statistics(docs), learn_quality(docs, table(spark, sf_dir, "labels")))


@query
def op11_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, learn_toxicity(docs, table(spark, sf_dir, "labels")))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    hashes = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    summary, texts = repair_conversations(damaged(given), Scratch(spark))
    found = summary.join(text_digests(texts), "head").withColumnsRenamed({"conv_id": "c", "sha": "repaired_sha256"})
    # Conversations that lost all their rows come back with nothing in them.
    every = given.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in SUMMARY[:-1]]
    return every.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


LLM_QUERIES["pipeline"] = run
