"""Finds short test items inside long documents: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by their shingles' length and number (powers of four). The sketch of an item is its bottom-k
MinHash: the k shingles of least hash, with k one more than the shingles a document may lack. A document that contains
enough of an item therefore holds at least one shingle of the sketch, whatever its own length, so nothing is lost.
Each partition is searched with its own bound, the largest hash that its sketches hold: large items have sketches low
in the range of hashes, so most shingles of a document never meet them. Pairs that meet are verified by the shingles
themselves. Only expressions, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalmeter.llm.words import SHINGLE, Scratch, words_of

CONTAINMENT = 0.8
#: Sketches of this many rows (24 bytes each) may be sent to every task; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def _runs(words: Column, n: int, of) -> Column:
    """``of`` the parts of each run of n words; no run in shorter texts."""
    last = F.size(words) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), of)).otherwise(F.array())


def _hashes(words: Column, n: int) -> Column:
    return _runs(words, n, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)]))


def _texts(words: Column, n: int) -> Column:
    return F.array_distinct(_runs(words, n, lambda i: F.array_join(F.slice(words, i + 1, n), " ")))


def _low(words: Column, n: int, parts: list[tuple[int, int]]) -> Column:
    """(n, part, h) of each run of n words that a partition's bound lets through."""
    most = max(bound for _, bound in parts)
    runs = F.array_distinct(F.filter(_hashes(words, n), lambda h: h <= F.lit(most)))
    one = lambda h, part, bound: F.when(h <= F.lit(bound), F.struct(F.lit(n).alias("n"), F.lit(part).alias("part"), h.alias("h")))
    return F.flatten(F.transform(runs, lambda h: F.array_compact(F.array(*[one(h, part, bound) for part, bound in parts]))))


def item_sketches(items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(item_id, n, size, part, sketch) per distinct item with words; n is the length of its shingles in words."""
    words = items.select("item_id", words_of(F.col("text")).alias("w")).distinct()
    sized = words.select("item_id", "w", F.least(F.size("w"), F.lit(SHINGLE)).alias("n")).where("n > 0")
    hashes = F.lit(None).cast("array<bigint>")
    for n in range(1, SHINGLE + 1):
        hashes = F.when(F.col("n") == n, _hashes(F.col("w"), n)).otherwise(hashes)
    ordered = sized.select("item_id", "n", F.array_sort(F.array_distinct(hashes)).alias("h")).withColumn("size", F.size("h"))
    allowed = F.floor((1 - threshold) * F.col("size") + 1e-9).cast("int")
    return ordered.select("item_id", "n", "size", F.floor(F.log2("size") / 2).cast("int").alias("part"), F.slice("h", F.lit(1), allowed + 1).alias("sketch"))


def contained_items(docs: DataFrame, items: DataFrame, scratch: Scratch, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): which items (item_id, text) stand in which documents.

    Containment is the share of an item's distinct shingles of five words that the document (doc_id, text, ...)
    holds; pairs at ``threshold`` or more are returned, once each. An item of fewer than five words is one shingle
    of that length. Items and documents that are null, empty or only white space are in no pair. Rows of one doc_id
    or item_id with different texts are looked at each, and the best containment counts; null ids are values like
    others. Other columns are ignored.
    """
    sketches = scratch.save(item_sketches(items, threshold), "sketches")
    bounds = sketches.groupBy("n", "part").agg(F.max(F.array_max("sketch")).alias("bound"), F.sum(F.size("sketch")).alias("rows")).collect()
    if not bounds:
        return docs.select("doc_id", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("n_shared"), F.lit(0).alias("n_item"), F.lit(0.0).alias("containment")).where("false")
    entry = sketches.select("item_id", "n", "part", F.explode("sketch").alias("h"))
    if sum(r["rows"] for r in bounds) <= BROADCAST_ROWS:
        entry = F.broadcast(entry)
    # One scan: the low shingles of each length, each with the partitions whose bound it does not pass.
    low = [_low(F.col("w"), n, [(r["part"], r["bound"]) for r in bounds if r["n"] == n]) for n in sorted({r["n"] for r in bounds})]
    worded = docs.select("doc_id", words_of(F.col("text")).alias("w"))
    seen = worded.select("doc_id", F.explode(F.flatten(F.array(*low))).alias("s")).select("doc_id", "s.*")
    met = scratch.save(seen.join(entry, ["n", "part", "h"]).select("doc_id", "item_id").distinct(), "met")

    # The pairs are few: the documents are joined with them before any text is moved.
    item = items.select(F.col("item_id").alias("i"), words_of(F.col("text")).alias("iw")).distinct().where("size(iw) > 0")
    text = docs.select(F.col("doc_id").alias("d"), "text").join(met, F.col("d").eqNullSafe(F.col("doc_id")))
    both = text.join(item, F.col("item_id").eqNullSafe(F.col("i"))).select("doc_id", "item_id", "iw", words_of(F.col("text")).alias("w"))
    shared = size = F.lit(None).cast("int")
    for n in range(1, SHINGLE + 1):
        is_n = F.least(F.size("iw"), F.lit(SHINGLE)) == n
        shared = F.when(is_n, F.size(F.array_intersect(_texts(F.col("w"), n), _texts(F.col("iw"), n)))).otherwise(shared)
        size = F.when(is_n, F.size(_texts(F.col("iw"), n))).otherwise(size)
    counted = both.select("doc_id", "item_id", shared.alias("n_shared"), size.alias("n_item")).withColumn("containment", F.col("n_shared") / F.col("n_item"))
    # Only what comes out of the aggregation is compared: a filter below it would repeat the whole expression.
    best = counted.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_item")).alias("b"))
    return best.where(F.col("b.containment") >= threshold - 1e-9).select("doc_id", "item_id", "b.n_shared", "b.n_item", "b.containment")
