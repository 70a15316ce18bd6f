"""Language model, classifier, mix, counts, URLs, top-k and main text: brute force, round trips and held-out rows."""

from __future__ import annotations

import glob
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from llm_data import corpus, prose, rows_of, words
from portalmeter.llm import edit_counts, gated_lm, source_mix
from portalmeter.llm.ball_tree import top_inner_products
from portalmeter.llm.dom_marginals import MAINS, Forest, Page, extract_main_text, labelled_pages, main_texts, marginals, model, train
from portalmeter.llm.quality_rules import STATISTICS, fit_rules, learn_quality, score_quality, with_statistics
from portalmeter.llm.url_templates import judge_urls, template_purities
from portalmeter.llm.words import arrow_batches


def test_base_scores_and_probabilities(docs, scratch):
    got = gated_lm.lm_scores(docs, scratch, chunk_chars=200_000).toPandas()
    assert len(got) == len(corpus())
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = {(r[0], r[1]): gated_lm.tokens(r[1]) for r in corpus()}
    c = Counter(w for r in corpus() if not held(r[0]) for w in tokens[(r[0], r[1])])
    n, v = sum(c.values()), len(c)
    base = lambda ws: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
    key = lambda a, b, k, s: (-1 if a is None or math.isnan(a) else int(a), int(b), int(k), round(float(s), 4))
    expected = sorted(key(r[0], len(t), sum(c[w] > 0 for w in t), base(t)) for r in corpus() for t in [tokens[(r[0], r[1])]])
    assert sorted(map(key, got.doc_id, got.n_tokens, got.n_known, got.base_score)) == expected
    assert (got.train_tokens == n).all() and (got.score < 0).all()
    assert rows_of(gated_lm.lm_scores(docs.limit(0), scratch)) == []


@pytest.mark.parametrize("dtype", [np.int8, np.int32, np.uint64])
def test_packed_numbers_come_back(dtype):
    for n in (0, 1, 7, 1000):
        numbers = np.random.default_rng(n).integers(np.iinfo(dtype).min, np.iinfo(dtype).max, n, dtype, endpoint=True)
        got = gated_lm.unpacked(gated_lm.packed(numbers), dtype)
        assert got.dtype == numbers.dtype and got.tolist() == numbers.tolist()


def test_chunks_are_stored_small_and_read_one_at_a_time(spark, scratch):
    some = prose(1, 500).split()
    r = random.Random(0)
    docs = spark.createDataFrame([(i, " ".join(r.choices(some, k=300))) for i in range(200)], "doc_id long, text string")
    gated_lm.lm_scores(docs.coalesce(1), scratch, chunk_chars=100_000)
    files = [pq.ParquetFile(p) for p in glob.glob(f"{scratch.root}/chunks/*.parquet")]
    groups = [(f, k) for f in files for k in range(f.num_row_groups)]
    assert len(groups) > 2 and all(f.metadata.row_group(k).num_rows == 1 for f, k in groups)
    for f, k in groups:
        chunk = f.read_row_group(k)
        # A key of 8 bytes for each word; tokens as plain numbers would take 4 bytes each besides.
        words = len(gated_lm.unpacked(chunk["keys"][0].as_py(), np.uint64))
        assert chunk.select(["ids", "keys", "spell", "n"]).nbytes < 10 * words + 2 * chunk["ends"][0].as_py()[-1] + 200


def test_batches_for_python_are_bounded(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    rows = spark.range(0, 12, 1, 1).selectExpr("repeat('x', 100000) x")
    count = lambda: [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    with arrow_batches(spark, 250_000):
        assert max(count()) < 5
    assert count() == [12]
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "100000")
    try:
        # The limit of the session stays.
        with arrow_batches(spark, 10_000_000):
            assert max(count()) < 3
        assert max(count()) < 3
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def vocabulary_of(texts):
    keys, spell, ends = gated_lm.hashed([t.encode() for t in texts])
    unique, counts = np.unique(keys, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    v = gated_lm.Vocabulary([(int(unique[i]), int(counts[i])) for i in order], {}, len(keys), len(unique))
    return v, np.split(v.ids(keys, spell.astype(np.int64)), ends[:-1])


def test_tokens_are_told_by_keys():
    texts = ["", "a B  c", " a\tb\nC ", "\u00c4 b 12 c!", "x" * 5000 + " " + "x" * 4999 + "y", "c b a", "abcdefghijklmnop \u4e2d"]
    keys, spell, ends = gated_lm.hashed([t.encode() for t in texts])
    parts = np.split(keys, ends[:-1])
    assert [len(p) for p in parts] == [len(gated_lm.tokens(t)) for t in texts] and all(p[-1] == gated_lm.END for p in parts)
    assert list(parts[1]) == list(parts[2]) == [*parts[5][:3][::-1], gated_lm.END]
    words = {w for t in texts for w in gated_lm.tokens(t)}
    assert len(np.unique(keys)) == len(words)
    assert list(np.split(spell, ends[:-1])[3][:4]) == [8, 0, 4, 12] and list(np.split(spell, ends[:-1])[6][:2]) == [3, 8]
    # However texts are put together, a word has one key.
    assert all(list(gated_lm.hashed([t.encode()])[0]) == list(p) for t, p in zip(texts, parts))


def test_the_network_gives_probabilities_and_learns():
    v, ids = vocabulary_of(["a b c a b", "a b c a b c a b c"] * 8)
    p, start = gated_lm.initial(v), v.start
    # All words and the classes of rare ones together have probability 1, but for classes without a word.
    h = np.random.default_rng(1).standard_normal((1, gated_lm.HIDDEN)).astype(np.float32)
    every = np.arange(v.n + gated_lm.SPELLINGS)
    log, _ = gated_lm.log_outputs(p, v, np.repeat(h, len(every), axis=0), every)
    e = np.exp(h @ p["class_out"] + p["class_bias"])[0]
    used = np.unique(v.class_of)
    assert np.exp(log).sum() == pytest.approx(e[used].sum() / e.sum(), abs=1e-5)
    before = gated_lm.score_documents(p, v, ids, start).sum()
    for _ in range(20):
        p = gated_lm.train_documents(p, v, ids, start, passes=3)
    after = gated_lm.score_documents(p, v, ids, start)
    assert after.sum() > 0.5 * before
    # Scores do not depend on what stands beside a document.
    assert np.allclose(gated_lm.score_documents(p, v, ids[:1], start), after[:1], atol=1e-4)


def test_the_state_is_carried_and_its_gradient_agrees_with_differences(monkeypatch):
    v, ids = vocabulary_of(["a b c a b", "c b a a", "b"])
    start, size = v.start, sum(map(len, ids))
    start_p = {k: x.astype(np.float64) for k, x in gated_lm.initial(v).items()}
    # One lane and one window over everything, and a step that is the gradient itself.
    monkeypatch.setattr(gated_lm, "LANES", 1)
    monkeypatch.setattr(gated_lm, "WINDOW", 1000)
    seen = {}
    monkeypatch.setattr(gated_lm.np, "clip", lambda g, *a, **k: seen.setdefault(len(seen), g.copy()))
    gated_lm.train_documents(start_p, v, ids, start)
    monkeypatch.undo()
    grads = {k: seen[i] * size**0.5 for i, k in enumerate(start_p)}
    total = lambda p: gated_lm.score_documents({k: x.astype(np.float64) for k, x in p.items()}, v, ids, start).sum()
    for name, at in (("gates", (3, 5)), ("gates", (2, 20)), ("gates", (1, 40)), ("gate_bias", (7,)), ("inputs", (1, 40)), ("inputs", (2, 3))):
        sides = []
        for step in (1e-3, -1e-3):
            moved = {k: x.copy() for k, x in start_p.items()}
            moved[name][at] += step
            sides.append(total(moved))
        assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(grads[name][at], abs=2e-3)


def test_gradients_agree_with_differences():
    v, _ = vocabulary_of(["a a a a a b b b b c c c"])
    p = {k: x.astype(np.float64) for k, x in gated_lm.initial(v).items()}
    h, target = np.random.default_rng(0).standard_normal((6, gated_lm.HIDDEN)), np.array([0, 1, 2, 3, 0, 5])
    grad = {k: np.zeros_like(x) for k, x in p.items()}
    _, back = gated_lm.log_outputs(p, v, h, target, grad)
    for name, at in (("class_out", (1, 2)), ("class_bias", (3,)), ("word_out", (0, 1))):
        moved = {k: x.copy() for k, x in p.items()}
        moved[name][at] += 1e-5
        change = (gated_lm.log_outputs(moved, v, h, target)[0] - gated_lm.log_outputs(p, v, h, target)[0]).sum() / 1e-5
        assert change == pytest.approx(grad[name][at], abs=1e-4)
    nudged = h.copy()
    nudged[2, 3] += 1e-5
    assert (gated_lm.log_outputs(p, v, nudged, target)[0] - gated_lm.log_outputs(p, v, h, target)[0]).sum() / 1e-5 == pytest.approx(back[2, 3], abs=1e-4)


def test_rules_tell_noise_from_prose(spark):
    rows = [(i, prose(i, 60) if i % 3 else " ".join(f"{w}$$$" for w in prose(i, 60).split())) for i in range(300)]
    rows += [(1000, None), (None, "x y"), (1001, ""), (1002, prose(5, 30_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(5, None), (None, 1), (7, 9)], "doc_id long, quality int")
    got = score_quality(with_statistics(docs), learn_quality(docs, labels)).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all() and got.score.notna().all()
    held = got[got.held_out & (got.doc_id < 300)]
    assert len(held) > 20 and (held.predicted == (held.doc_id % 3 > 0)).all()
    none = learn_quality(docs, labels.limit(0))
    assert {r["score"] for r in score_quality(with_statistics(docs), none).collect()} == {0.5}


def test_lasso_keeps_few_rules():
    r = np.random.default_rng(0)
    x = r.uniform(size=(2000, len(STATISTICS)))
    model = fit_rules(x, (x[:, 4] > 0.7).astype(float))
    assert 0 < len(model.rules) < 40 and any(n == STATISTICS[4] for rule in model.rules for n, _, _ in rule)


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None), key=str.encode) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("shard_words", [1 << 22, 4000])
def test_mix(docs, scratch, shard_words):
    mixed = source_mix.mix_sources(docs, scratch, block_words=64, shard_words=shard_words)
    got = source_mix.taken_words(mixed).join(docs.select("doc_id", "source").distinct(), "doc_id", "left").toPandas()
    assert len(got) == len(corpus())
    assert sorted(got["size"]) == sorted(len(words(r[1])) for r in corpus())
    assert (got.taken <= 2 * got["size"]).all()
    sizes = Counter()
    for r in corpus():
        sizes[r[3]] += len(words(r[1]))
    expected = targets_by_hand(sizes)
    by_source = {r["source"]: (r["t"], r["w"]) for r in mixed.groupBy("source").agg({"target": "max", "n_words": "sum"}).toDF("source", "t", "w").collect()}
    for s, target in expected.items():
        assert by_source[s][0] == pytest.approx(target) and abs(by_source[s][1] - target) <= 1
    places = mixed.where("n_words > 0").select("shard", "place").collect()
    assert len(set(places)) == len(places) and all(s is not None for s, _ in places)


def test_permutations_are_whole_and_not_rotations(spark):
    from pyspark.sql import functions as F

    for size in (1, 2, 6, 7, 151, 1000):
        got = spark.range(size).select(source_mix.permuted(F.col("id"), F.lit(size).cast("long"), F.lit(7), F.lit(3)).alias("p")).orderBy("id").collect()
        order = [r["p"] for r in got]
        assert sorted(order) == list(range(size))
        if size > 100:
            assert len({(b - a) % size for a, b in zip(order, order[1:])}) > size / 3


def test_a_shard_without_a_block_takes_nothing(spark, docs, scratch):
    from pyspark.sql import functions as F

    columns = "doc_id long, size long, source string, source_size long, target double, row struct<sid:long>, sid long, u long, copy int, n_words long, block long"
    pieces = spark.createDataFrame([(i, 10, "a", 30, 30.0, (i,), 0, i, 0, 10, i) for i in range(3)], columns)
    dealt = spark.createDataFrame([(0, 5, 0), (0, 6, 2)], "sid long, shard int, block long")
    got = {r["doc_id"]: (r["shard"], r["n_words"]) for r in source_mix.in_shards(pieces, dealt, 7).collect()}
    assert got == {0: (5, 10), 1: (None, 0), 2: (6, 10)}
    # What a document gives is what its parts give.
    taken = source_mix.taken_words(source_mix.mix_sources(docs, scratch, block_words=64, shard_words=4000))
    off = taken.where(F.col("taken") != F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["n_words"]))
    assert off.count() == 0 and taken.where("size(parts) > 1").count() > 0


def test_hypergeometric_draws_have_the_right_mean_and_spread(spark):
    from pyspark.sql import functions as F

    u = F.shiftrightunsigned(F.xxhash64("id"), 11) * 2.0**-53
    draw = source_mix.hypergeometric(F.lit(5000).cast("long"), F.lit(1200).cast("long"), F.lit(700).cast("long"), u)
    mean, spread = spark.range(4000).select(draw.alias("k")).agg(F.avg("k"), F.variance("k")).first()
    expected = 700 * 0.24 * 0.76 * 4300 / 4999
    assert abs(mean - 168) < 1 and abs(spread / expected - 1) < 0.12
    edges = spark.range(50).select(source_mix.hypergeometric(F.lit(9).cast("long"), F.lit(9).cast("long"), F.lit(4).cast("long"), u).alias("k"))
    assert {r["k"] for r in edges.collect()} == {4}


def test_counts_after_edits_are_those_of_the_edited_text(spark, docs):
    count = edit_counts.counter(edit_counts.VOCABULARY, edit_counts.PATTERN)
    whole = lambda t: sum(count.tokens(count.pattern.findall(t)))
    r = random.Random(5)
    for _ in range(300):
        state = edit_counts.EditableCount(prose(r.randint(1, 99), r.randint(0, 60)), count, r.choice([1, 2, 7]))
        for _ in range(5):
            at, n = r.randint(0, len(state.text) + 1), r.choice([0, 3, 40])
            new = "".join(r.choice(["'", "s", "ve", " ", "  ", "\n", "9", "é", "!!", "Word "]) for _ in range(r.randint(0, 6)))
            expected = state.text[:at] + new + state.text[at + n :]
            state.edit(at, n, new)
            assert (state.text, state.tree.n_chars, state.tree.n_tokens) == (expected, len(expected), whole(expected))
    from pyspark.sql import functions as F

    edited = docs.withColumn("edits", edit_counts.derived_edits(F.coalesce("text", F.lit("")), F.col("doc_id")))
    got = edit_counts.count_tokens(edited).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(whole(r[1] or "") for r in corpus())
    assert all(r["encoded_chars"] < 3000 for r in got)
    none = edit_counts.count_tokens(docs.withColumn("edits", F.lit(None).cast("array<struct<start:int,length:int,new:string>>")))
    assert all(r["n_tokens"] == r["edited_tokens"] for r in none.collect())


def test_urls(spark, scratch):
    urls = ["http://A.net/x", "https://b.example.net/en/1?q", "http://example.net/enx", "https://x.example.com/de/5#t", "http://example.com/d", "http://c.org/fr/9", "http://notnet/x", "http://a.net", None, "no url", "", "x://H/p?a://b/c", "http://a.net/x", "http://a.net/" + "y/" * 5000]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, scratch).collect()}
    assert got[0] == ("a.net", "/x", "net/", "block") and got[1] == ("b.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("example.net", "/enx", "net/", "block") and got[3][2:] == ("example.com/de/", "block") and got[4][2] is None
    assert got[5][2:] == ("org/fr/", "allow") and got[6][2] is None and got[7][:3] == ("a.net", "", None)
    assert got[8][:3] == got[9][:3] == got[10][:3] == ("", "", None) and got[11][:2] == ("h", "/p") and got[13][3] == "block"
    assert len(got) == len(urls) and {v[3] for v in got.values()} == {"allow", "block"}
    assert rows_of(judge_urls(pages.limit(0), scratch)) == []


def test_templates_follow_their_labels(spark, scratch):
    rules = [("h", "/ads/1", "block"), ("h", "/news/1", "allow")]
    urls = [f"http://h/{kind}/{n}" for kind in ("ads", "news") for n in range(1000, 3000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    free = judge_urls(pages, scratch, rules).where("rule is null").collect()
    assert free and all(r["template"].endswith("/*") and r["verdict"] == ("block" if "/ads/" in r["path"] else "allow") for r in free)


def purities_by_hand(units):
    """Template and purity of (host, segments): (n, blocked, labelled), by walking the tree of each host."""
    cut, share = {}, lambda b, n, s: (b + 4 * s) / (n + 4)
    total = [sum(u[i] for u in units.values()) for i in (1, 2)]

    def walk(node, done, above, count):
        # node: {key: rest}; above: the purity of the node that they came from.
        if len(set(node.values())) == 1:
            return cut.update({k: ("/".join(done + r), above) for k, r in node.items()})
        while all(node.values()) and len({r[0] for r in node.values()}) == 1:
            done, node = done + next(iter(node.values()))[:1], {k: r[1:] for k, r in node.items()}
        cut.update({k: ("/".join(done), above) for k, r in node.items() if not r})
        seen = Counter()
        for k, r in node.items():
            if r:
                seen[r[0]] += units[k][0]
        literal = [n for s, n in seen.items() if s != "*"]
        wide = len(literal) >= 8 and sum(literal) / len(literal) < 3
        children = {}
        for k, r in node.items():
            if r:
                children.setdefault("*" if wide and seen[r[0]] < 3 else r[0], {})[k] = r[1:]
        sums, bands, alike = {}, {}, {}
        for name, child in children.items():
            b, n = sums[name] = [sum(units[k][i] for k in child) for i in (1, 2)]
            mine, rest, all_ = (b + 1) / (n + 2), (count[0] - b + 1) / (count[1] - n + 2), (count[0] + 2) / (count[1] + 4)
            if abs(mine - rest) / math.sqrt(all_ * (1 - all_) * (1 / (n + 2) + 1 / (count[1] - n + 2))) >= 1.96:
                band = bands[name] = min(7, int(math.asin(math.sqrt(mine)) * 16 / math.pi))
                alike[band] = [x + y for x, y in zip(alike.get(band, (0, 0)), (b, n))]
        for name, child in children.items():
            walk(child, (*done, name), share(*alike[bands[name]], above) if name in bands else above, sums[name])

    for host in {h for h, _ in units}:
        mine = {k: k[1] for k in units if k[0] == host}
        count = [sum(units[k][i] for k in mine) for i in (1, 2)]
        walk(mine, (), share(*count, share(*total, 0.5)), count)
    return cut


def test_template_trees_are_those_built_node_by_node(spark, scratch):
    r = random.Random(4)
    names = ["a", "b", "ads", "news", "*", "x1"]
    units = {}
    for _ in range(400):
        kind = r.choice(["short", "long", "rare", "tail"])
        deep = ["same"] * 40 + [r.choice(names) for _ in range(r.randint(0, 3))]
        path = {"short": [r.choice(names) for _ in range(r.randint(0, 3))], "long": deep, "rare": ["id", f"k{r.random()}", r.choice(names)], "tail": [r.choice(names)] * r.randint(1, 9)}[kind]
        labelled = r.randint(0, 30)
        heavy = labelled if "ads" in path else r.randint(0, labelled)
        units[(r.choice(["h", "g"]), tuple(path))] = (r.randint(1, 2) if kind == "rare" else labelled + 1, heavy, labelled)
    units[("alone", ("p",) * 300)] = (1, 0, 0)
    df = spark.createDataFrame([(h, list(p), *u) for (h, p), u in units.items()], "host string, segments array<string>, n long, blocked long, labelled long")
    got = {(x["host"], tuple(x["segments"])): ("/".join(x["template"]), x["purity"]) for x in template_purities(df, scratch).collect()}
    expected = purities_by_hand(units)
    assert set(got) == set(expected) == set(units)
    for key, (template, purity) in expected.items():
        assert got[key][0] == template and got[key][1] == pytest.approx(purity)
    assert sum("*" in t for t, _ in expected.values()) > 50 and max(t.count("/") for t, _ in expected.values()) > 40
    assert len({round(p, 9) for _, p in expected.values()}) > 8


def test_top_inner_products(spark, scratch):
    r = random.Random(2)
    rows = [(i, [float(r.choice([-0.5, 0.25, 0.125, 0.3])) for _ in range(6)]) for i in range(300)]
    rows += [(400, None), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6), (700, [1.0, 2.0]), (800, [3.0, 4.0]), (None, [1.0] * 6), (900, []), (7, rows[7][1])]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted(rows_of(top_inner_products(df, scratch, shard_rows=40, block_queries=2).select("query_id", "rank", "vec_id", "score")))
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q, v in good:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:10], 1)]
    assert got == sorted(expected)
    assert rows_of(top_inner_products(df.limit(0), scratch)) == []


def test_marginals_are_those_of_all_labellings():
    import itertools

    pages = [Page("<div><p>a</p><ul><li>b</li></ul></div>"), Page(""), Page("<p>c</p><p>d</p>")]
    forest, all_own = Forest(pages), np.array([0.3, -0.7, 1.1, 0.2, -0.4, 0.6, -0.1, 0.9, -1.2])
    tie = np.array([[0.5, -0.2], [0.1, 0.9]])
    share, pairs = marginals(forest, all_own, tie)
    expected_pairs = np.zeros((2, 2))
    for page, start in zip(pages, forest.starts):
        n = len(page.tags)
        own = all_own[start : start + n]
        weight = {s: math.exp(sum(o * x for o, x in zip(own, s)) + sum(tie[s[page.parents[i]], s[i]] for i in range(1, n))) for s in itertools.product((0, 1), repeat=n)}
        total = sum(weight.values())
        for i in range(n):
            assert share[start + i] == pytest.approx(sum(w for s, w in weight.items() if s[i]) / total)
            for s, w in weight.items():
                if i:
                    expected_pairs[s[page.parents[i]], s[i]] += w / total
    assert pairs == pytest.approx(expected_pairs) and forest.starts[-1] == len(all_own)


def test_main_text_of_layouts_that_were_not_learnt():
    # Every third layout is kept back; counted are the nodes that hold text.
    for back in range(3):
        kept = [i for i in range(len(MAINS)) if i % 3 != back]
        weight, tie = train(labelled_pages(kept))
        found = right = real = 0
        pages = [Page(p) for p in labelled_pages([i for i in range(len(MAINS)) if i % 3 == back])]
        forest = Forest(pages)
        share, _ = marginals(forest, forest.own(weight), tie)
        for page, start in zip(pages, forest.starts):
            for i in range(len(page.tags)):
                if page.chars[i] and not page.hidden[i]:
                    found += share[start + i] >= 0.5
                    real += page.labels[i]
                    right += page.labels[i] and share[start + i] >= 0.5
        print(f"layouts {back}: precision {right / found:.3f}, recall {right / real:.3f} of {real} blocks")
        assert right / found > 0.9 and right / real > 0.9


@pytest.mark.parametrize("body, expected", [
    ("<p>a <math><mi>x</mi><mo>=</mo></math> b</p>", "a x= b"), ("<p>a <svg><title>t</title><text>u</text></svg> b</p>", "a tu b"), ("<p>one <button>two</button></p>", "one two"),
    ("<p>one <noscript>two</noscript> <object>three</object></p>", "one two three"), ("<p>one</p>\n<p", "one"), ("<p>one</p>two</", "one\ntwo</"), ("<p>one <a href='x>two</a> three</p>", "one two three"),
    ("<p>a <b>1 < 2</b> &lt;p&gt;</p>", "a 1 < 2 <p>"), ("<p>a<iframe>x</iframe><template><p>y</p></template>b</p>", "ab"), ("<xmp><b>&amp;</xmp><p>c", "<b>&amp;\nc"), ("<p>a</><!-- b", "a"),
])
def test_only_markup_goes(body, expected):
    assert main_texts([f"<html><body><article>{body}"], *model()) == [expected]


def test_main_text(spark):
    weight, tie = model()
    html = '<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/a>A</a></ul></nav><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; more</h1><p>One  two<b>three</b><p>Four&eacute;<script>var t="</p>";</script></article><aside>Else</aside><div id="comments"><p>Nice, I like it.</p></div><form><p>Mail</p></form><footer>&copy; x</footer>'
    assert main_texts([html], weight, tie) == ["Head & more\nOne twothree\nFouré"]
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (4, "u", "<article><p>" + "word " * 50_000), (None, "u", "<p"), (1, "u", html)]
    got = extract_main_text(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert got[1]["text"] == got[2]["text"] == "" and len(got[3]["text"]) == 249_999
    assert extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").limit(0)).collect() == []
    assert main_texts(["<div>" * 3000 + "<article><p>deep</p></article>"], weight, tie) == ["deep"]
