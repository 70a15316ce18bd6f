"""Near-duplicate texts by DartMinHash: sparse weighted signatures from hashed darts, banded joining, exact check.

Each element (a shingle of five words) owns a strip of the plane, as wide as its weight; darts fall on the plane at
a rate of one per unit of area, at places fixed by hashes of the element and of the unit cell. Each dart belongs to
one of ``k`` coordinates. The signature keeps, per coordinate, the earliest dart (least rank) under the text's
strips. Two texts agree in a coordinate with the probability of their weighted Jaccard similarity. Only as many
ranks are looked at as it takes to fill every coordinate: about k ln k darts, whatever the text's length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portalmeter.llm.components import components
from portalmeter.llm.words import Scratch, mix, shingle_hashes, text_bytes, window_hashes, word_hashes

SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no band once in 300,000 pairs.
BANDS, ROWS = 24, 4
#: Members of a bucket that meet in one task of the last check.
BLOCK = 256

# Ranks are cut at powers of two; the first cell is [0, 2 ** _LOWEST).
_LOWEST = -6
_POISSON = {rate: np.cumsum([math.exp(-rate) * rate**i / math.factorial(i) for i in range(16)]) for rate in (2.0**e for e in range(_LOWEST, 1))}


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _cells(level: int) -> list[tuple[float, float]]:
    """The rank cells (start, width) between the ends of two levels; each has one dart per unit of weight at most."""
    if level == _LOWEST:
        return [(0.0, 2.0**_LOWEST)]
    start = 2.0 ** (level - 1)
    return [(start, start)] if start <= 1 else [(start + i, 1.0) for i in range(int(start))]


def dart_signatures(elements: list[np.ndarray], weights: list[np.ndarray], k: int) -> np.ndarray:
    """A row of k 64-bit values for each weighted set (no weight below 0, one above 0 at least)."""
    out = np.zeros((len(elements), k), dtype=np.uint64)
    total = np.array([w.sum() for w in weights])
    need = k * (math.log(k) + 3) / total
    top = np.maximum(_LOWEST, np.ceil(np.log2(need))).astype(int)
    for level in np.unique(top):
        rows = np.flatnonzero(top == level)
        # A few hundred thousand units of weight at a time.
        for part in np.split(rows, np.flatnonzero(np.diff(np.cumsum(total[rows]) // 200_000)) + 1):
            if len(part):
                out[part] = _signatures(elements, weights, part, int(level), k)
    return out


def _signatures(elements: list[np.ndarray], weights: list[np.ndarray], rows: np.ndarray, level: int, k: int) -> np.ndarray:
    sizes = [len(elements[r]) for r in rows]
    owner = np.repeat(np.arange(len(rows)), sizes)
    element = np.concatenate([elements[r] for r in rows])
    weight = np.concatenate([weights[r] for r in rows]).astype(np.float64)
    # Strips are cut into cells of unit width; the last of an element may be narrower.
    widths = np.maximum(np.ceil(weight), 1).astype(np.int64)
    if (widths > 1).any():
        first = np.cumsum(widths) - widths
        cell = np.arange(widths.sum()) - np.repeat(first, widths)
        owner, element, weight = (np.repeat(x, widths) for x in (owner, element, weight))
        room = weight - cell
        seed = mix(element + np.uint64(0x632BE59BD9B4E019) * cell.astype(np.uint64))
    else:
        room, seed = weight, mix(element)
    partial = bool((room < 1).any())
    best = np.full(len(rows) * k, np.inf)
    at = _LOWEST
    while True:
        for start, width in _cells(at):
            self_seed = mix(seed ^ np.float64(start + 2.0**-40).view(np.uint64))
            many = np.searchsorted(_POISSON[width], _unit(self_seed))
            hit = np.flatnonzero(many)
            dart = np.repeat(self_seed[hit], many[hit])
            nth = np.arange(len(dart)) - np.repeat(np.cumsum(many[hit]) - many[hit], many[hit])
            dart = mix(dart + np.uint64(0xA0761D6478BD642F) * (nth.astype(np.uint64) + np.uint64(1)))
            rank = start + width * _unit(dart)
            more = mix(dart ^ np.uint64(0x8BB84B93962EACC9))
            who = np.repeat(hit, many[hit])
            if partial:
                under = _unit(mix(more)) < room[who]
                rank, more, who = rank[under], more[under], who[under]
            np.minimum.at(best, owner[who] * k + (more % np.uint64(k)).astype(np.int64), rank)
        if at >= level and not np.isinf(best).any():
            return best.view(np.uint64).reshape(len(rows), k)
        if at >= level and np.isinf(best).any():
            open_rows = np.flatnonzero(np.isinf(best.reshape(len(rows), k)).any(axis=1))
            if len(open_rows) < len(rows):
                done = best.view(np.uint64).reshape(len(rows), k).copy()
                done[open_rows] = _signatures(elements, weights, rows[open_rows], at + 1, k)
                return done
        at += 1


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit value for each band of each signature; the band's number is part of it."""
    parts = signatures.reshape(len(signatures), bands, rows)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, i])
    return total


def weighted_shingles(words: np.ndarray, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text with their weights: one each, or how often they stand in it."""
    if not counted or len(words) < 5:
        found = shingle_hashes(words)
        return found, np.ones(len(found))
    found, often = np.unique(window_hashes(words, 5), return_counts=True)
    return found, often.astype(np.float64)


_SIGNED = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
)


def signed(docs: DataFrame, bands: int, rows: int, counted: bool) -> DataFrame:
    """(doc_id, node, bands) of each row: node stands for the text, bands is null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [weighted_shingles(w, counted) for w in word_hashes(text_bytes(part.column(2)))]
                full = [i for i, (e, _) in enumerate(sets) if len(e)]
                out: list = [None] * len(sets)
                if full:
                    signatures = dart_signatures([sets[i][0] for i in full], [sets[i][1] for i in full], bands * rows)
                    for i, values in zip(full, band_hashes(signatures, bands, rows).view(np.int64), strict=True):
                        out[i] = values
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "node", "bands"]
                )

    plain = docs.select(F.col("doc_id").cast("long"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(run, _SIGNED)


def _similarity(counted: bool):
    @F.pandas_udf("double")
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str, y: str) -> float:
            (ea, wa), (eb, wb) = (weighted_shingles(w, counted) for w in word_hashes([x.encode(), y.encode()]))
            _, ia, ib = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
            both = np.minimum(wa[ia], wb[ib]).sum()
            return float(both / (wa.sum() + wb.sum() - both))

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return similarity


def _block_links(counted: bool, threshold: float):
    """Links between the two sides of a block, as few as connect what is similar: at most one less than its texts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["side", "node"])
        left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
        tables = [[weighted_shingles(w, counted) for w in word_hashes(t.encode() for t in side.text)] for side in (left, right)]
        sums = np.array([w.sum() for _, w in tables[1]])
        # An index of the right side: for each shingle the texts that hold it.
        where = np.repeat(np.arange(len(right)), [len(e) for e, _ in tables[1]])
        held, kept = np.concatenate([e for e, _ in tables[1]]), np.concatenate([w for _, w in tables[1]])
        order = np.argsort(held, kind="stable")
        held, where, kept = held[order], where[order], kept[order]
        roots = right.root.to_numpy()
        out = []
        for node, root, (elements, weight) in zip(left.node, left.root, tables[0], strict=True):
            lo, hi = np.searchsorted(held, elements, "left"), np.searchsorted(held, elements, "right")
            span = hi - lo
            at = np.repeat(lo - np.cumsum(span) + span, span) + np.arange(span.sum())
            both = np.bincount(where[at], np.minimum(kept[at], np.repeat(weight, span)), len(right))
            near = both / (weight.sum() + sums - both) >= threshold
            # One link to each component it is near to.
            mine = [i for i in np.flatnonzero(near) if roots[i] != root]
            out += [(node, right.node.iloc[i]) for i in {roots[i]: i for i in mine}.values()]
        return pd.DataFrame(out, columns=["u", "v"])

    return run


def near_duplicate_classes(
    docs: DataFrame,
    scratch: Scratch,
    threshold: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    weights: str = "set",
) -> DataFrame:
    """(doc_id, node, class_id, class_size, is_kept) for each row of docs (doc_id, text, ...); node stands for the text.

    Texts are linked if the Jaccard similarity of their shingles of five words is ``threshold`` or more, exactly
    checked; a class is what links connect, and class_id its smallest doc_id. ``weights="count"`` weighs a shingle
    by how often it stands in the text.

    Equal texts are one node. Each text of a bucket (an equal band) is checked against three pivots of it: the
    first, the last, and the one with the least hash. Where a bucket still holds several components afterwards, the
    texts outside its largest one are checked against all of it, in blocks of bounded size that give back only the
    links needed. So no pair of a large group is ever a row, and no link between components is lost.

    Null and empty texts, and those of white space only, are classes of their own row each. Null doc_ids come last
    when the smallest is chosen; a class of nulls only has class_id null. Of repeated rows one is kept. Other
    columns are ignored.
    """
    counted = {"set": False, "count": True}[weights]
    table = scratch.save(signed(docs, bands, rows, counted), "signed")
    full = table.where("bands is not null")
    one = full.groupBy("node").agg(F.min("bands").alias("bands"))
    entry = scratch.save(one.select("node", F.explode("bands").alias("band")), "entry")
    bucket = entry.groupBy("band").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("mid"), F.count("*").alias("members")
    ).where("low <> high")
    member = scratch.save(entry.join(bucket, "band").select("node", "band", "low", "high", F.col("mid.node").alias("mid"), "members"), "member")
    scratch.drop("entry")

    # The texts of the nodes in any such bucket, once each.
    wanted = member.select("node").distinct()
    texts = docs.where("text is not null").select(F.unhex(F.md5("text")).alias("node"), "text")
    text = scratch.save(texts.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "text")

    pair = member.select(F.explode(F.array("low", "high", "mid")).alias("u"), F.col("node").alias("v")).where("u <> v")
    pair = pair.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    checked = pair.join(text.select(F.col("node").alias("u"), F.col("text").alias("a")), "u").join(text.select(F.col("node").alias("v"), F.col("text").alias("b")), "v")
    links = scratch.save(checked.where(_similarity(counted)("a", "b") >= threshold).select("u", "v"), "links")
    roots = scratch.save(components(links, scratch, "first"), "roots")

    # Buckets of more than three members may hold pairs that no pivot has seen.
    wide = member.where("members > 3").select("node", "band").join(roots, "node", "left").select("node", "band", F.coalesce("root", "node").alias("root"))
    shares = wide.groupBy("band", "root").agg(F.count("*").alias("n"))
    split = shares.groupBy("band").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("members"), F.count("*").alias("parts")).where("parts > 1")
    open_ = wide.join(split.select("band", F.col("most.root").alias("main"), "members", (F.col("members") - F.col("most.n")).alias("outside")), "band")
    block = lambda node, n: F.pmod(F.xxhash64(node), F.ceil(F.col(n) / BLOCK)).cast("int")
    count = lambda n: F.sequence(F.lit(0), (F.ceil(F.col(n) / BLOCK) - 1).cast("int"))
    right = open_.select("band", "node", "root", F.lit(1).alias("side"), F.explode(count("outside")).alias("l"), block("node", "members").alias("r"))
    left = open_.where("root <> main").select("band", "node", "root", F.lit(0).alias("side"), block("node", "outside").alias("l"), F.explode(count("members")).alias("r"))
    blocks = left.union(right).join(text, "node").groupBy("band", "l", "r").applyInPandas(_block_links(counted, threshold), "u binary, v binary")
    more = scratch.save(blocks.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "more")
    all_roots = components(links.union(more), scratch, "second")

    owned = full.select("doc_id", "node").join(all_roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root"), "doc_id", "node").agg(F.count("*").alias("n"))
    size = owned.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "node")).alias("head"), F.sum("n").alias("class_size"))
    head = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("node") == F.col("head.node"))
    classed = owned.join(size, "root").select("doc_id", "node", F.col("head.doc_id").alias("class_id"), "class_size", head.alias("head"), "n")
    # A row for each copy; of those at the head of the class one is kept.
    copies = F.transform(F.sequence(F.lit(1).cast("long"), F.col("n")), lambda i: F.col("head") & (i == 1))
    classed = classed.select("doc_id", "node", "class_id", "class_size", F.explode(copies).alias("is_kept"))
    alone = table.where("bands is null").select("doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("is_kept"))
    return classed.union(alone)
