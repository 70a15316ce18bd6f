"""Near-duplicates, repeated passages and benchmark containment against brute force."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np

from llm_data import corpus, prose, rows_of, shingles, sorted_rows, words
from portalmeter.llm.containment import contained_items
from portalmeter.llm.dart_minhash import dart_signatures, near_duplicate_classes
from portalmeter.llm.substring_dedup import digest, remove_repeats
from portalmeter.llm.words import shingle_hashes, window_hashes, word_hashes


def test_word_hashes_follow_the_words():
    texts = ["", "a b  c", " a\tb\nc ", "ä b c", "x" * 3_000_000 + " a", None, "c b a"]
    got = list(word_hashes(t.encode() if t else None for t in texts))
    assert [len(x) for x in got] == [len(words(t)) for t in texts]
    assert list(got[1]) == list(got[2]) and got[3][0] != got[1][0] and list(got[1][1:]) == list(got[3][1:])
    assert got[4][1] == got[1][0]
    assert len(window_hashes(got[1], 5)) == 0 and len(shingle_hashes(got[1])) == 1


def test_signatures_agree_as_often_as_weighted_sets_are_alike():
    random = np.random.default_rng(0)
    elements = random.integers(1, 2**63, 60).astype(np.uint64)
    a, b = random.uniform(0.1, 4, 60), random.uniform(0.1, 4, 60)
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    one, two = dart_signatures([elements, elements], [a, b], 3000)
    assert abs((one == two).mean() - expected) < 0.04
    assert (dart_signatures([elements[:1]], [np.array([0.2])], 64) != 0).all()


def classes_by_hand(rows):
    texts = sorted({r[1] for r in rows if shingles(r[1])})
    group = {t: t for t in texts}

    def root(t):
        while group[t] != t:
            t = group[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        x, y = shingles(a), shingles(b)
        if len(x & y) / len(x | y) >= 0.8:
            group[root(a)] = root(b)
    ids = {}
    for r in rows:
        if shingles(r[1]) and r[0] is not None:
            ids.setdefault(root(r[1]), []).append(r[0])
    return {(r[0], r[1]): min(ids.get(root(r[1]), [None])) if shingles(r[1]) else r[0] for r in rows}


def test_classes(docs, scratch):
    expected = classes_by_hand(corpus())
    got = near_duplicate_classes(docs, scratch).toPandas()
    assert len(got) == len(corpus())
    rows = sorted(((None if np.isnan(a) else int(a), None if np.isnan(b) else int(b)) for a, b in zip(got.doc_id, got.class_id)), key=repr)
    assert rows == sorted(((k[0], v) for r in corpus() for k, v in [((r[0], r[1]), expected[(r[0], r[1])])]), key=repr)
    # One row of each class is kept, also of repeated rows.
    worded = got[got.class_size > 1]
    assert (worded.groupby("class_id").is_kept.sum() == 1).all()
    assert got[got.doc_id == 16].is_kept.sum() == 1


def test_a_chain_in_one_bucket_is_not_lost(spark, scratch):
    # Texts that differ from a base in more and more words: neighbours are alike, the ends are not.
    base = prose(20, 200).split()
    chain = [" ".join([*(f"new{j}" for j in range(3 * i)), *base[3 * i :]]) for i in range(12)]
    rows = [(i, t, None, None, 0, 0, None, None) for i, t in enumerate(chain)]
    df = spark.createDataFrame(rows, "doc_id long, text string, a string, b string, c int, d int, e string, f string")
    expected = classes_by_hand(rows)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicate_classes(df, scratch).collect()}
    assert got == {k[0]: v for k, v in expected.items()} and len(set(got.values())) == 1


def repeats_by_hand(rows):
    # Rows of one doc_id are parts of a document in the order of their fingerprints.
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
    seen, out = set(), {}
    for r in sorted({(r[0], r[1] or "") for r in rows}, key=key):
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            window = tuple(w[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.setdefault(r[0], []).append((r[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted((x for v in out.values() for x in v), key=repr)


def test_repeats(docs):
    got = remove_repeats(docs).select("doc_id", "n_words", "n_removed", digest("kept_text"))
    assert sorted_rows(got) == repeats_by_hand(corpus())


def test_repeats_in_many_texts_without_id(spark, monkeypatch):
    # Numbered in stretches, not by pairs: each text of an id keeps its place, and only its own passages go.
    from portalmeter.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "STRETCH", 1)
    passage = prose(50, 30)
    rows = [(None, f"{prose(100 + i, 5)} {passage if i % 3 else prose(900 + i, 30)} {prose(500 + i, 4)}") for i in range(300)]
    rows += [(7, prose(2000 + i, 25)) for i in range(40)] + [(7, passage), (8, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = substring_dedup.numbered(df)
    parts = sorted((r["doc"], r["part"]) for r in plain.collect())
    assert parts == sorted([(2**63 - 1, i) for i in range(300)] + [(7, i) for i in range(41)] + [(8, 0)])
    got = remove_repeats(df).select("doc_id", "n_words", "n_removed", digest("kept_text"))
    assert sorted_rows(got) == repeats_by_hand(rows)
    assert rows_of(remove_repeats(df.limit(0))) == []


def test_containment(spark, docs, scratch):
    text = {r[0]: r[1] for r in corpus()}
    passage = text[6].split()[50:75]
    items = [(1, " ".join(passage)), (2, " ".join([*passage[:24], "other"])), (3, prose(30, 30)), (4, None), (5, " "), (6, "two three"), (7, "three two"), (1, " ".join(passage))]
    items.append((None, " ".join(passage[:6])))
    got = contained_items(docs, spark.createDataFrame(items, "item_id long, text string"), scratch)
    grams = lambda w, n: {tuple(w[j : j + n]) for j in range(len(w) - n + 1)}
    worded, expected = [(r[0], words(r[1])) for r in corpus()], set()
    for i, t in {x for x in items if words(x[1])}:
        n = min(5, len(words(t)))
        item = grams(words(t), n)
        expected |= {(d, i) for d, w in worded if len(item & grams(w, n)) / len(item) >= 0.8}
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected and len(expected) > 8
    assert got.count() == len(expected)


def test_empty_tables(spark, docs, scratch):
    none = docs.limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(near_duplicate_classes(none, scratch)) == []
    assert rows_of(remove_repeats(none)) == []
    assert rows_of(contained_items(docs, items, scratch)) == []
    assert rows_of(contained_items(none, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"), scratch)) == []
