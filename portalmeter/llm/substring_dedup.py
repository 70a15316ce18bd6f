"""Removes passages that also stand earlier in the corpus: seeds from winnowed anchors, extended to whole windows.

An anchor is the run of ``SEED`` words with the least hash among those of a window, so two equal windows have equal
anchors at equal places. Documents are joined on anchors; around each anchor that stands in more than one place the
match is extended both ways to all windows that it anchors, and every window that also starts earlier is part of a
repeat. Runs of such windows are the maximal repeats of the threshold's length or more.

Of equal anchors or windows within a task only one goes through a shuffle, so a passage of any number of copies is
at most one row a task. Windows are told apart by 96 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portalmeter.llm.words import mix, text_bytes, window_hashes, word_hashes

THRESHOLD, SEED = 20, 6
#: Rows held in a task before those that are equal are joined and the rest sent on.
HELD = 1_000_000
#: Digits of a fingerprint that tell apart the stretches in which the texts of one doc_id are numbered.
STRETCH = 4

_PART = 1 << 32


def anchors(words: np.ndarray, threshold: int) -> np.ndarray:
    """For each window of a text the place of its anchor: of the seeds in it the first with the least hash."""
    if len(words) < threshold:
        return np.empty(0, np.int64)
    grams = window_hashes(words, min(SEED, threshold))
    reach = threshold - min(SEED, threshold) + 1
    # The least of each stretch from the least of two stretches half as long, again and again.
    best, span = np.arange(len(grams)), 1
    while span < reach:
        step = min(span, reach - span)
        a, b = best[:-step], best[step:]
        best = np.where(grams[b] < grams[a], b, a)
        span += step
    return best


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, part, text): a row for each text, in order of doc, then part.

    Rows of one doc_id with different texts follow one another as parts of a document, in the order of their texts;
    equal rows are one; null doc_ids come last, as one document. Where doc_ids are unique nothing is shuffled.
    """
    ids = docs.select("doc_id")
    odd = ids.groupBy("doc_id").count().where("doc_id is null or count > 1").limit(1).count()
    plain = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    if not odd:
        return plain.select("doc", F.lit(0).alias("part"), "text")
    # The place of a text among those of its document, from their fingerprints alone: those of the stretches before its
    # own, and those before it in its stretch. So neither pairs nor all texts of a document meet.
    marks = plain.select("doc", F.md5("text").alias("mark")).distinct()
    marks = marks.join(marks.groupBy("doc").count().where("count > 1").select("doc"), "doc", "left_semi").withColumn("stretch", F.substring("mark", 1, STRETCH))
    sizes = marks.groupBy("doc", "stretch").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("doc").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("doc", "stretch", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = marks.withColumn("inside", F.row_number().over(Window.partitionBy("doc", "stretch").orderBy("mark")))
    ranks = inside.join(before, ["doc", "stretch"]).select("doc", "mark", (F.col("before") + F.col("inside") - 1).cast("int").alias("part"))
    keyed = plain.withColumn("mark", F.md5("text")).dropDuplicates(["doc", "mark"])
    return keyed.join(ranks, ["doc", "mark"], "left").select("doc", F.coalesce("part", F.lit(0)).alias("part"), "text")


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Whether each row of sorted columns begins a new group."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _passed(doc: np.ndarray) -> np.ndarray:
    return mix(doc.view(np.uint64)).view(np.int64)


_SEEDS = ["seed", "doc", "place", "state"]
_NEW, _KNOWN, _DONE = 0, 1, 2


def _seed_rows(threshold: int):
    """Anchors of each text. Of those seen twice in the task one goes on as known, all are marked as done."""

    def send(seed: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(seed, kind="stable")
        seed, doc, place = seed[order], doc[order], place[order]
        first = _groups(seed)
        size = np.diff(np.append(np.flatnonzero(first), len(seed)))
        many = np.repeat(size > 1, size)
        one, done = first, many
        return _batch(
            _SEEDS,
            np.concatenate([seed[one].view(np.int64), _passed(doc[done])]),
            np.concatenate([doc[one], doc[done]]),
            np.concatenate([place[one], place[done]]),
            np.concatenate([np.where(many[one], _KNOWN, _NEW), np.full(done.sum(), _DONE)]).astype(np.int8),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0
        for batch in batches:
            docs, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for doc, part, words in zip(docs, parts, word_hashes(text_bytes(batch.column(2))), strict=True):
                at = anchors(words, threshold)
                if len(at):
                    at = np.unique(at)
                    held.append((window_hashes(words, min(SEED, threshold))[at], np.full(len(at), doc), at + int(part) * _PART))
                    rows += len(at)
                if rows >= HELD:
                    yield send(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, rows = [], 0
        if held:
            yield send(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Batches in the order of their first columns, so cut that no group spans two."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        if not len(columns[0]):
            continue
        cut = int(np.flatnonzero(_groups(*columns[:keys]))[-1])
        if cut:
            yield [c[:cut] for c in columns]
        rest = [c[cut:] for c in columns]
    if rest is not None and len(rest[0]):
        yield rest


def _shared_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of anchors that stand in several."""
    for seed, doc, place, state in _whole_groups(batches, 1):
        live = state != _DONE
        size = np.diff(np.append(np.flatnonzero(_groups(seed)), len(seed)))
        starts = np.cumsum(size) - size
        # A row that only passes through may share its number with an anchor.
        real = np.repeat(np.add.reduceat(live.astype(int), starts), size)
        out = ~live | (state == _NEW) & (real > 1)
        if out.any():
            yield _batch(["doc", "place"], doc[out], place[out])


def _run_rows(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    new = np.flatnonzero(np.append(True, (np.diff(place) != 1) | (np.diff(doc) != 0)))
    return doc[new], place[new], np.diff(np.append(new, len(doc)))


_WINDOWS = ["key", "more", "doc", "place", "length"]


def _window_rows(threshold: int):
    """All windows around shared anchors: the earliest of the task with its key; the others as repeats (length > 0)."""

    def send(key: np.ndarray, more: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((place, doc, more, key))
        key, more, doc, place = key[order], more[order], doc[order], place[order]
        first = _groups(key, more)
        seen, start, length = _run_rows(doc[~first], place[~first]) if not first.all() else (doc[:0], place[:0], place[:0])
        return _batch(
            _WINDOWS,
            np.concatenate([key[first].view(np.int64), _passed(seen)]),
            np.concatenate([more[first], np.zeros(len(seen), np.int32)]),
            np.concatenate([doc[first], seen]),
            np.concatenate([place[first], start]),
            np.concatenate([np.zeros(first.sum(), np.int64), length]).astype(np.int32),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for doc, part, words, shared in zip(columns[0].to_numpy(), columns[1].to_numpy(), word_hashes(text_bytes(columns[2])), columns[3], strict=True):
                offset = int(part) * _PART
                mine = np.asarray(shared.values) - offset
                at = anchors(words, threshold)
                near = np.flatnonzero(np.isin(at, mine))
                if len(near):
                    held.append((window_hashes(words, threshold, 1)[near], (window_hashes(words, threshold, 2)[near] >> np.uint64(32)).astype(np.uint32).view(np.int32), np.full(len(near), doc), near + offset))
                    rows += len(near)
                if rows >= HELD:
                    yield send(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, rows = [], 0
        if held:
            yield send(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows that start earlier elsewhere."""
    for key, more, doc, place, length in _whole_groups(batches, 2):
        run = length > 0
        again = ~run
        if again.any():
            again[again] = ~_groups(key[again], more[again])
        if run.any():
            yield _batch(["doc", "start", "length"], doc[run], place[run], length[run].astype(np.int64))
        if again.any():
            yield _batch(["doc", "start", "length"], *_run_rows(doc[again], place[again]))


def _part_of(place: str) -> Column:
    return F.shiftright(place, 32).cast("int").alias("part")


def repeated_windows(plain: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc, start, length): runs of windows that also start earlier."""
    seeds = plain.select("doc", "part", "text").mapInArrow(_seed_rows(threshold), "seed long, doc long, place long, state byte")
    shared = seeds.repartition("seed").sortWithinPartitions("seed").mapInArrow(_shared_seeds, "doc long, place long")
    places = shared.groupBy("doc", _part_of("place")).agg(F.collect_list("place").alias("shared"))
    around = plain.join(places.hint("shuffle_hash"), ["doc", "part"]).select("doc", "part", "text", "shared")
    windows = around.mapInArrow(_window_rows(threshold), "key long, more int, doc long, place long, length int")
    ordered = windows.repartition("key").sortWithinPartitions("key", "more", "doc", "place")
    return ordered.mapInArrow(_later_windows, "doc long, start long, length long")


def _removal(threshold: int, keep_gaps: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, lengths = (pa.array(batch.column(i)).to_pylist() for i in (3, 4))
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200)
                counts, gone, kept, marks = [], [], [], []
                for i, (part, text) in enumerate(zip(piece.column(1).to_numpy(), text_bytes(piece.column(2)), strict=True)):
                    words = text.split()
                    covered = np.zeros(len(words) + 1, np.int64)
                    for start, length in zip(starts[at + i] or (), lengths[at + i] or (), strict=True):
                        begin = start - int(part) * _PART
                        if 0 <= begin < len(words):
                            covered[begin] += 1
                            covered[begin + length + threshold - 1] -= 1
                    out = np.cumsum(covered[:-1]) > 0
                    marks.append(hashlib.md5(text).hexdigest())
                    counts.append(len(words))
                    gone.append(int(out.sum()))
                    if not gone[-1]:
                        kept.append((text if keep_gaps else b" ".join(words)).decode())
                    else:
                        kept.append(b" ".join(w for w, o in zip(words, out, strict=True) if not o).decode())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(marks), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc", "mark", "n_words", "n_removed", "kept_text"],
                )

    return run


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, keep_gaps: bool = False) -> DataFrame:
    """(doc_id, mark, n_words, n_removed, kept_text) for each row of docs (doc_id, text, ...), repeated rows once.

    ``mark`` is the MD5 of the text as it was.

    A word goes if a window of ``threshold`` words over it, within its document, also starts earlier: in a document
    of smaller doc_id, or before in the same one. Kept words are joined by one space; with ``keep_gaps`` a text that
    loses nothing stays as it is. Null texts have no words. Other columns are ignored.
    """
    plain = numbered(docs).where("doc is not null")
    found = repeated_windows(plain, threshold).groupBy("doc", _part_of("start")).agg(F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))
    joined = plain.join(found.hint("shuffle_hash"), ["doc", "part"], "left").select("doc", "part", "text", "starts", "lengths")
    kept = joined.mapInArrow(_removal(threshold, keep_gaps), "doc long, mark string, n_words long, n_removed long, kept_text string")
    return kept.select(F.nullif("doc", F.lit(2**63 - 1)).alias("doc_id"), "mark", "n_words", "n_removed", "kept_text")


def digest(kept_text: Column) -> Column:
    return F.sha2(kept_text, 256)
