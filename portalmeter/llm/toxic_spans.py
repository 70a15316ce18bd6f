"""Toxic spans by a linear-chain conditional random field, and a toxicity score for each text.

Each word is tagged toxic or not. A tag's potential comes from the word and its beginnings (4, 5 and 6 bytes), and
neighbouring tags are tied. Document labels give the words to learn from: in texts labelled clean no word is toxic, in
the others those words are whose features stand far more often in toxic texts. Weights follow the gradient of the
log-likelihood, whose expectations come from forward-backward passes. The same passes give the marginals of new texts;
runs of toxic words are the offending spans, and a logistic curve over the marginals of a text is its score.

The passes run over the words of many texts at once: the chain is folded into lanes that are read side by side, each as
the product of its two-by-two matrices, so that they take a few array operations per lane length and are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalmeter.llm.words import mix

#: Labelled texts that are learnt from, at most, of each label: those with the smallest hashes of their doc_id.
SAMPLE_ROWS = 1_500
#: Features of fewer texts are not weighed. One marks toxic words if the logarithm of its odds, and that of how unlikely
#: its toxic texts would be by chance, reach these.
LEAST_TEXTS, LEAST_ODDS, LEAST_SURPRISE = 4, 2.5, 10.0
BEGINNINGS = (4, 5, 6)
ROUNDS, STEP, DECAY = 15, 0.5, 1e-3
THRESHOLD = 0.5

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), ord("'"), *range(0x80, 0x100)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, _BASE), dtype=np.uint64)


# --- words and their features --------------------------------------------------------------------------------


@dataclass
class Words:
    """The words of texts laid end to end: of which text each is, its bytes' start and length, and its features."""

    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    features: np.ndarray


def lowered(text: str) -> str:
    """Lower case with as many characters as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def words_in(texts: list[str]) -> tuple[Words, np.ndarray]:
    """The words of lower-case texts, and the bytes of all texts with a line feed behind each."""
    parts = [t.encode("utf-8", "replace") + b"\n" for t in texts]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    at = np.flatnonzero(_IS_WORD[buf])
    if not len(at):
        none = np.empty(0, np.int64)
        return Words(none, none, none, np.empty((0, 1 + len(BEGINNINGS)), np.uint64)), buf
    opens = np.flatnonzero(np.append(True, np.diff(at) > 1))
    size = np.diff(np.append(opens, len(at)))
    start = at[opens]
    place = np.arange(len(at)) - np.repeat(opens, size)
    # Powers go round after 64 bytes, with the place's turn mixed in.
    values = (buf[at].astype(np.uint64) + np.uint64(1) + (place >> 6).astype(np.uint64) * np.uint64(0x100000001B3)) * _POWERS[place & 63]
    columns = [mix(np.add.reduceat(values, opens) + size.astype(np.uint64))]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    for n in BEGINNINGS:
        # A word no longer than that is its own beginning.
        part = sums[opens + np.minimum(size, n)] - sums[opens]
        columns.append(mix(part + np.uint64(n << 32)))
    return Words(np.searchsorted(ends, start, side="right"), start, size, np.column_stack(columns)), buf


# --- the chain -----------------------------------------------------------------------------------------------


def _forward(own: np.ndarray, tie: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(tag | words up to it), and the logarithm of what each word adds to the sum over all taggings.

    ``own`` is the log-potential of toxic, that of the other tag is 0; ``tie`` holds potentials of pairs [before][tag];
    ``fresh`` marks words that begin a text.
    """
    n = len(own)
    lanes = max(1, int(np.sqrt(n)))
    steps = -(-n // lanes)
    pad = steps * lanes - n
    fold = lambda x, fill: np.ascontiguousarray(np.append(x, np.full(pad, fill)).reshape(lanes, steps).T)
    e = fold(np.exp(np.clip(own, -30, 30)), 1.0)
    # Rows of the matrix of each word: from the tag before to its own; a first word forgets what was before.
    new = fold(fresh, True)
    a, c = np.where(new, 1.0, tie[0, 0]), np.where(new, 1.0, tie[1, 0])
    b, d = np.where(new, 1.0, tie[0, 1]) * e, np.where(new, 1.0, tie[1, 1]) * e
    # The product of each lane, up to scale.
    p, q, r, s = (np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes))
    for t in range(steps):
        p, q, r, s = p * a[t] + q * c[t], p * b[t] + q * d[t], r * a[t] + s * c[t], r * b[t] + s * d[t]
        if t % 4 == 3:
            scale = 1 / (p + q + r + s)
            p, q, r, s = p * scale, q * scale, r * scale, s * scale
    enter, share = np.empty(lanes), 0.5
    for i, (x, y, z, w) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        enter[i] = share
        none, toxic = (1 - share) * x + share * z, (1 - share) * y + share * w
        share = toxic / (none + toxic)
    out, total = np.empty((steps, lanes)), np.empty((steps, lanes))
    share = enter
    for t in range(steps):
        toxic = b[t] + share * (d[t] - b[t])
        total[t] = a[t] + share * (c[t] - a[t]) + toxic
        share = out[t] = toxic / total[t]
    return out.T.ravel()[:n], np.log(total).T.ravel()[:n]


def marginals(own: np.ndarray, log_tie: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(toxic) of each word, the expected pairs of tags [before][tag] at each word, and each word's part of log Z."""
    tie = np.exp(log_tie)
    forward, grown = _forward(own, tie, fresh)
    # Backward, as a forward pass over the words from the end: a word that ends a text begins there.
    last = np.append(fresh[1:], True)
    turned, _ = _forward(own[::-1], tie.T, last[::-1])
    e = np.exp(np.clip(own, -30, 30))
    # ``turned`` counts the word's own potential as well, which the forward share has in it already.
    behind1 = turned[::-1] / e
    behind0 = 1 - turned[::-1]
    toxic, none = forward * behind1, (1 - forward) * behind0
    share = toxic / (toxic + none)
    before = np.append(0.5, forward[:-1])
    pairs = np.stack([(1 - before) * tie[0, 0] * behind0, (1 - before) * tie[0, 1] * e * behind1, before * tie[1, 0] * behind0, before * tie[1, 1] * e * behind1], axis=1)
    pairs /= pairs.sum(axis=1, keepdims=True)
    pairs[fresh] = 0
    return share, pairs, grown


# --- the model -----------------------------------------------------------------------------------------------


@dataclass
class ToxicModel:
    """Sorted feature hashes with their weights, the weight of any word, the ties, and the curve of a text's score."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    log_tie: np.ndarray
    curve: np.ndarray

    def own(self, features: np.ndarray) -> np.ndarray:
        out = np.full(len(features), self.bias)
        if len(self.keys):
            for column in features.T:
                at = np.minimum(np.searchsorted(self.keys, column), len(self.keys) - 1)
                out += np.where(self.keys[at] == column, self.weights[at], 0.0)
        return out


def text_signs(share: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """(1, log-odds of the surest word, logarithm of the expected toxic words) of each of n texts."""
    clipped = np.clip(share, 1e-9, 1 - 1e-9)
    surest = np.full(n, np.log(1e-9))
    np.maximum.at(surest, text, np.log(clipped / (1 - clipped)))
    expected = np.bincount(text, clipped, n)
    return np.column_stack([np.ones(n), surest, np.log(expected + 1e-3)])


def _fresh(words: Words) -> np.ndarray:
    return np.append(True, np.diff(words.text) != 0) if len(words.text) else np.empty(0, bool)


def marked_features(words: Words, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features (sorted) that stand in enough texts to be weighed, and which of them mark toxic words."""
    n, n_bad = len(toxic), toxic.sum()
    keys, texts = [], []
    for column in words.features.T:
        # Each feature once a text.
        order = np.lexsort((words.text, column))
        key, text = column[order], words.text[order]
        new = np.append(True, (np.diff(text) != 0) | (key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
        keys.append(key[new])
        texts.append(text[new])
    keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    bad = np.bincount(at, toxic[np.concatenate(texts)], len(keys))
    good = np.bincount(at, minlength=len(keys)) - bad
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n - n_bad + 1))
    # What stands in a few texts only, or as often in both kinds, says nothing.
    kept = (bad + good >= LEAST_TEXTS) & (np.abs(odds) > 1)
    surprise = bad * np.log((bad + 0.5) / (bad + good + 1) * n / n_bad)
    return keys[kept], (surprise[kept] >= LEAST_SURPRISE) & (odds[kept] >= LEAST_ODDS)


def fit(texts: list[str], toxic: np.ndarray, rounds: int = ROUNDS) -> ToxicModel:
    """Learns from texts and labels 0 and 1. No texts give the score 0.5, a single label its smoothed share."""
    share = (toxic.sum() + 0.5) / (len(toxic) + 1)
    nothing = ToxicModel(np.empty(0, np.uint64), np.empty(0), -10.0, np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    if len(np.unique(toxic)) < 2:
        return nothing
    words, _ = words_in([lowered(t) for t in texts])
    if not len(words.text):
        return nothing
    keys, marks = marked_features(words, toxic)
    at = np.searchsorted(keys, words.features)
    at = np.where((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == words.features), at, len(keys)) if len(keys) else np.zeros(words.features.shape, np.int64)
    tags = (toxic[words.text] == 1) & np.append(marks, False)[at].any(axis=1)
    fresh = _fresh(words)
    inner = ~fresh
    pairs_seen = np.zeros((2, 2))
    np.add.at(pairs_seen, (tags[:-1][inner[1:]].astype(int), tags[1:][inner[1:]].astype(int)), 1)
    weights, bias, log_tie = np.zeros(len(keys) + 1), -3.0, np.zeros((2, 2))
    seen = np.bincount(at.ravel(), np.repeat(tags, at.shape[1]), len(keys) + 1)
    speed_w, speed_b, speed_t = np.full(len(keys) + 1, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    total = max(1.0, float(tags.sum()))
    for _ in range(rounds):
        p, pairs, _ = marginals(bias + weights[at].sum(axis=1), log_tie, fresh)
        grad = (seen - np.bincount(at.ravel(), np.repeat(p, at.shape[1]), len(keys) + 1)) / total - DECAY * weights
        grad[-1] = 0
        grad_b = (tags.sum() - p.sum()) / total
        grad_t = (pairs_seen - pairs.sum(axis=0).reshape(2, 2)) / total - DECAY * log_tie
        speed_w, speed_b, speed_t = speed_w + grad**2, speed_b + grad_b**2, speed_t + grad_t**2
        weights += STEP * grad / np.sqrt(speed_w)
        bias += STEP * grad_b / np.sqrt(speed_b)
        log_tie = log_tie + STEP * grad_t / np.sqrt(speed_t)
    model = ToxicModel(keys, weights[:-1], float(bias), log_tie, np.zeros(3))
    p, _, _ = marginals(model.own(words.features), log_tie, fresh)
    model.curve = _logistic(text_signs(p, words.text, len(texts)), toxic)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-2) -> np.ndarray:
    """Weights by Newton's method, slightly drawn towards 0."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - decay * w
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + decay * np.eye(len(w)), slope)
    return w


def tagged(texts: list[str], model: ToxicModel) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """The score of each text, and its toxic spans: first character, length, and the surest marginal."""
    words, buf = words_in([lowered(t) for t in texts])
    if len(words.text):
        p, _, _ = marginals(model.own(words.features), model.log_tie, _fresh(words))
    else:
        p = np.empty(0)
    signs = text_signs(p, words.text, len(texts))
    score = 1 / (1 + np.exp(-np.clip(signs @ model.curve, -30, 30)))
    spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    hit = np.flatnonzero(p >= 0.5)
    if len(hit):
        # Characters before each byte, of all texts end to end; and where each text begins.
        chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        runs = np.split(hit, np.flatnonzero((np.diff(hit) > 1) | (np.diff(words.text[hit]) != 0)) + 1)
        for run in runs:
            text = int(words.text[run[0]])
            begin = int(chars[words.start[run[0]]] - starts[text])
            end = int(chars[words.start[run[-1]] + words.size[run[-1]]] - starts[text])
            spans[text].append((begin, end - begin, float(p[run].max())))
    return score, spans


# --- Spark ---------------------------------------------------------------------------------------------------


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether a row is kept from learning; a null doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(False))


def learn_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicModel:
    """Learns from labelled rows (doc_id, toxic) outside the held-out part, ``sample_rows`` of each label at most.

    Labels that are null or neither 0 nor 1, and those without a document, are not used; several labels of a document
    each count. The sample of ids is sent to every task and its texts to the driver, as their number is bounded.
    """
    usable = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    of = lambda label: usable.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = of(0).union(of(1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    # Rows of one doc_id could be many: no more texts than labels are fetched.
    first = lambda label: rows.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(sample_rows)
    table = first(0).union(first(1)).select("text", "toxic").collect()
    return fit([r["text"] or "" for r in table], np.array([float(r["toxic"]) for r in table]))


_SPANS = "array<struct<start:int,length:int,probability:double>>"


def score_toxicity(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) for each row of docs (doc_id, text, ...).

    ``spans`` are the runs of words with a marginal of a half or more, as first character and length, in order of the
    text. A null text counts as empty; a text without words has no span and the score of the least signs. Rows are
    independent of each other, so repeated rows give equal results; no rows give none; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("probability", pa.float64())]))
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                score, spans = tagged(part.column(2).to_pylist(), model)
                listed = [[dict(zip(("start", "length", "probability"), s, strict=True)) for s in each] for each in spans]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array(listed, span)], names=["doc_id", "held_out", "score", "spans"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    scored = plain.mapInArrow(run, f"doc_id long, held_out boolean, score double, spans {_SPANS}")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
