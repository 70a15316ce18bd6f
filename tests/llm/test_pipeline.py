"""The stages in turn, on a small corpus with odd cases, and the registered queries."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from llm_data import corpus, words
from portalmeter.llm.words import Scratch
from portalmeter.llm.queries import LLM_QUERIES


def test_stages(spark, docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    text = {r[0]: r[1] for r in corpus()}
    items = [(1, " ".join(text[6].split()[60:90]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    scratch, kept = Scratch(spark), {}
    table = docs
    for name, stage in corpus_pipeline.STAGES:
        table = scratch.save(stage(spark, table, folder), name)
        kept[name] = table.count()
        if name != "source_mix":
            assert table.columns == docs.columns
    # One label of one kind rejects nothing; copies, near copies and repeated rows go; so do texts with the item.
    assert kept["quality_classifier"] == len(corpus())
    assert kept["near_dedup"] == len(corpus()) - 6
    assert kept["substring_dedup"] == kept["near_dedup"]
    assert kept["decontamination"] == kept["near_dedup"] - 1
    repeats = {r["doc_id"]: r for r in spark.read.parquet(f"{scratch.root}/substring_dedup").collect()}
    assert len(words(repeats[7]["text"])) == 30 and repeats[7]["n_chars"] == len(repeats[7]["text"])
    assert repeats[8]["text"] is None and repeats[18]["text"] == text[18]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the given tables are not here")
@pytest.mark.parametrize("name", list(LLM_QUERIES))
def test_queries_run(spark, name):
    assert registry.queries()[name] is LLM_QUERIES[name]
    assert LLM_QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
