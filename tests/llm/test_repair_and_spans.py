"""Toxic spans, cuts in the middle and repaired conversations against brute force."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import corpus, prose, rows_of
from portalmeter.llm import conversation_repair as repair
from portalmeter.llm import toxic_spans
from portalmeter.llm.fill_in_middle import Boundaries, WaveletMatrix, fill_in_middle, restored
from portalmeter.llm.queries import LLM_QUERIES

# --- toxic spans ---------------------------------------------------------------------------------------------


def test_marginals_are_those_of_all_taggings():
    r = np.random.default_rng(3)
    own, tie = r.standard_normal(9) * 2, r.standard_normal((2, 2))
    fresh = np.zeros(9, bool)
    fresh[[0, 4, 5]] = True
    weight, share, pairs = {}, np.zeros(9), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=9):
        weight[tags] = math.exp(sum(own[i] * x for i, x in enumerate(tags)) + sum(tie[tags[i - 1], tags[i]] for i in range(9) if not fresh[i]))
    z = sum(weight.values())
    for tags, w in weight.items():
        share += np.array(tags) * w / z
        for i in range(9):
            if not fresh[i]:
                pairs[tags[i - 1], tags[i]] += w / z
    got, got_pairs, grown = toxic_spans.marginals(own, tie, fresh)
    assert np.allclose(got, share) and np.allclose(got_pairs.sum(axis=0).reshape(2, 2), pairs)
    assert grown.sum() == pytest.approx(math.log(z))


def test_toxic_words_are_learnt_and_found(spark):
    r = random.Random(4)

    def text(i, bad):
        said = prose(i, r.randint(3, 60)).split()
        for _ in range(3 if bad else 0):
            said.insert(r.randint(0, len(said)), r.choice(["Zorgling", "zorglax", "(vrakk!)", "ÄVRAKKé"]))
        return " ".join(said)

    rows = [(i, text(i, i % 4 == 0), "clash") for i in range(400)]
    odd = [(1000, None, ""), (1001, "", ""), (1002, " \n", ""), (None, "zorgling a", ""), (1003, prose(5, 30_000) + " zorglum zorgling", ""), (1003, "vrakk", ""), (1003, "vrakk", "")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, held_out string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(5, None), (None, 1), (7, 9), (9999, 1)], "doc_id long, toxic int")
    model = toxic_spans.learn_toxicity(docs, labels)
    got = toxic_spans.score_toxicity(docs, model).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= g["score"] <= 1 for g in got)
    held = [g for g in got if g["held_out"] and g["doc_id"] < 400]
    assert len(held) > 50 and all(g["predicted"] == (g["doc_id"] % 4 == 0) for g in held)
    assert all(g["held_out"] == (g["doc_id"] is not None and zlib.crc32(str(g["doc_id"]).encode()) % 5 == 0) for g in got)
    whole = {(i, t) for i, t, _ in rows + odd}
    for g in got:
        mine = [t for i, t in whole if i == g["doc_id"]]
        if len(mine) == 1:
            found = [mine[0][s["start"] : s["start"] + s["length"]] for s in g["spans"]]
            assert all(re.fullmatch(r"\w+(\W+\w+)*", f) and re.search("(?i)zorg|vrakk", f) for f in found) if g["predicted"] else not found
    assert next(g for g in got if g["doc_id"] == 1003 and len(g["spans"]) == 1 and g["spans"][0]["start"] > 1000)["predicted"] == 1
    assert rows_of(toxic_spans.score_toxicity(docs.limit(0), model)) == []
    none = toxic_spans.learn_toxicity(docs, labels.limit(0))
    assert {g["score"] for g in toxic_spans.score_toxicity(docs, none).collect()} == {0.5}


# --- fill in the middle --------------------------------------------------------------------------------------


def test_ranks_are_counts():
    r = np.random.default_rng(0)
    for size in (0, 1, 63, 64, 65, 700):
        classes = r.integers(0, 4, size).astype(np.uint8)
        matrix = WaveletMatrix(classes)
        for place in {0, size // 3, size // 2, max(0, size - 1), size}:
            assert [matrix.rank(c, place) for c in range(4)] == [int((classes[:place] == c).sum()) for c in range(4)]


@pytest.mark.parametrize("unit, pattern", [("line", r"[^\n]*\n|[^\n]+"), ("word", r"[^\n \t\x0b\x0c\r]*[\n \t\x0b\x0c\r]|[^\n \t\x0b\x0c\r]+"), ("sentence", r"[^\n.!?]*[\n.!?]|[^\n.!?]+")])
def test_boundaries(unit, pattern):
    for text in ["", "\n", "a", "a\n", "\n\na b. c! é\x85 x", "x" * 200 + "\n" + "y. z \n" * 50, "\U0001f600\n\U0001f600."]:
        units = re.findall(pattern, text)
        found = Boundaries(text, unit)
        assert found.n == len(units)
        assert [found.end_of(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_middles(spark, docs):
    extra = [(20, "a\nb <S> c", "", "", 0, 0, "", ""), (21, "eine\nzweite\n\ndrei \U0001f600\n", "", "", 0, 0, "", "")]
    every = docs.union(spark.createDataFrame(extra, docs.schema))
    got = fill_in_middle(every).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    expected = []
    for i, t, *_ in corpus() + extra:
        t, h = t or "", hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        lines = re.findall(r"[^\n]*\n|[^\n]+", t)
        a, b = sorted(int(h[k : k + 8], 16) % (len(lines) + 1) for k in (0, 8))
        p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
        form = "plain" if not t or any(x in t for x in ("<P>", "<S>", "<M>")) else "spm" if int(h[24:32], 16) % 100 < 50 else "psm"
        out = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        expected.append((i, len(lines), form, None if form == "plain" else len(p), None if form == "plain" else len(m), out, t))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert {g["form"] for g in got} == {"plain", "psm", "spm"} and rows_of(fill_in_middle(docs.limit(0))) == []
    assert {g["form"] for g in fill_in_middle(docs, rate=0).collect()} == {"plain"}


# --- conversations -------------------------------------------------------------------------------------------

GAPS = " \t\n\x0b\x0c\r"


def repaired_by_hand(rows):
    """The summary of one conversation of (turn, role, text) by Dijkstra over (cost, audit)."""
    rows = sorted(((t is not None, t or 0, r or (" " if r is None else ""), " " if x is None else x) for t, r, x in rows))
    seen, faults = set(), []
    for *_, role, text in rows:
        kind = "blank" if not text.strip(GAPS) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(GAPS)[-1] not in ".!?" else None
        faults.append(kind)
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, last, out = heapq.heappop(queue)
        if (i, last) in done:
            continue
        if i == len(rows) and last in ("", "a"):
            break
        done.add((i, last))
        follows = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        name = {"u": "user", "a": "assistant"}[follows]
        heapq.heappush(queue, (cost + 3, audit + "I", i, follows, (*out, f"{name}:")))
        if i < len(rows):
            *_, role, text = rows[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, last, out))
            if faults[i] in (None, "truncated"):
                more = 3 if faults[i] else 0
                if role[:1] == follows or last == "" and role[:1] == "s":
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                heapq.heappush(queue, (cost + 3 + more, audit + "R", i + 1, follows, (*out, f"{name}:{text}")))
    turns = [t for known, t, *_ in rows if known]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def conversations(n):
    r = random.Random(7)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(r.choice([1, 2, 5, 9, 30])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["One.", "Two", "Three!", " \n", "", None, f"Text {r.random()}.", f"T {r.random()}", "Ünd?  "])
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None]), role, text))
    return list(dict.fromkeys(rows)) + rows[:3]


@pytest.mark.parametrize("block, parts", [(512, 2), (4, 2), (1, 7)])
def test_repairs(spark, scratch, block, parts):
    rows = conversations(60)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        summary, texts = repair.repair_conversations(df, scratch, block)
        got = sorted(rows_of(summary.join(repair.text_digests(texts), "head").drop("head")), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = [(c, *repaired_by_hand([r[1:] for r in rows if r[0] == c])) for c in {r[0] for r in rows}]
    assert got == sorted(expected, key=repr)


def test_a_long_conversation(spark, scratch):
    r = random.Random(1)
    rows = [(1, i, r.choice(["user", "assistant"]), r.choice([f"Text {i}.", f"Text {i}", "Again.", ""])) for i in range(3000)]
    summary, texts = repair.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), scratch)
    got = rows_of(summary.join(repair.text_digests(texts), "head").drop("head"))
    assert got == [(1, *repaired_by_hand([x[1:] for x in rows]))]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rows_of(repair.repair_conversations(none, scratch)[0]) == []


def test_damaged_conversations(spark, tmp_path):
    rows = list(dict.fromkeys(conversations(80)))
    rows += [(200 + i, 0, "user", "Hello.") for i in range(60)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(rows_of(LLM_QUERIES["op13_conversation_repair"](spark, str(tmp_path))), key=repr)
    expected = []
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        expected.append((conv, *(repaired_by_hand(kept) if kept else nothing)))
    assert got == sorted(expected, key=repr) and any(e[7] == "" for e in expected)
