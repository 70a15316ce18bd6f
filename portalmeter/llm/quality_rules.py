"""Quality classifier: a sparse ensemble of rules over text statistics, scored as Spark column expressions.

Shallow boosted trees over statistics of labelled texts give rules: each path from a root to a node is a
conjunction of comparisons. A lasso-penalised logistic regression over all rules gives most of them no weight; the
others become one column expression. Statistics and scores are plain expressions that Spark runs over every text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalmeter.llm.words import GAP, words_of

#: Labelled rows that the rules are learnt from, at most: those with the smallest hashes of their doc_id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, CUTS = 40, 3, 24
PENALTY = 2e-3
THRESHOLD = 0.3

STATISTICS = ("chars", "words", "word_chars", "distinct", "capitals", "symbols", "marks", "digits", "accents", "lines")


def statistics(text: Column, words: Column) -> list[Column]:
    """The columns of STATISTICS, all double and never null; shares of an empty text are 0."""
    n = F.length(text)
    share = lambda pattern: F.coalesce(1 - F.length(F.regexp_replace(text, pattern, "")) / F.nullif(n, F.lit(0)), F.lit(0.0))
    per = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    values = (
        F.log1p(n.cast("double")),
        F.log1p(F.size(words).cast("double")),
        per(F.length(F.regexp_replace(text, GAP, "")), F.size(words)),
        per(F.size(F.array_distinct(words)), F.size(words)),
        share("\\p{Lu}+"),
        share("[^\\p{L}\\p{N}\\s.,;:!?'\"()\\-]+"),
        share("[!?]+"),
        share("\\p{N}+"),
        share("[^\\x00-\\x7F]+"),
        per(F.length(text) - F.length(F.regexp_replace(text, "\n", "")) + 1, F.size(words)),
    )
    return [v.cast("double").alias(name) for v, name in zip(values, STATISTICS, strict=True)]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(row columns of docs, but for the text, and STATISTICS); a null text counts as empty."""
    kept = [c for c in docs.columns if c != "text"]
    text = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_text"))
    return text.withColumn("_words", words_of(F.col("_text"))).select(*kept, *statistics(F.col("_text"), F.col("_words")))


@dataclass
class RuleModel:
    """Rules as lists of (statistic, is above, cut), their weights, and the intercept."""

    intercept: float
    rules: list[tuple[tuple[str, bool, float], ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self) -> Column:
        """The probability of label 1, from the columns of STATISTICS."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            test = F.lit(True)
            for name, above, cut in rule:
                test = test & ((F.col(name) > cut) if above else (F.col(name) <= cut))
            total = total + F.when(test, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, path: tuple, depth: int, out: list, step: np.ndarray) -> None:
    """Splits greedily by the gain of a Newton step; collects each path and adds the leaves' steps."""
    gain = lambda g, h: g * g / (h + 1.0)
    best = (1e-3, None)
    if depth < DEPTH:
        whole = gain(grad[rows].sum(), hess[rows].sum())
        for j in range(x.shape[1]):
            slot = np.searchsorted(cuts[j], x[rows, j], side="left")
            g = np.cumsum(np.bincount(slot, grad[rows], len(cuts[j]) + 1))[:-1]
            h = np.cumsum(np.bincount(slot, hess[rows], len(cuts[j]) + 1))[:-1]
            won = gain(g, h) + gain(grad[rows].sum() - g, hess[rows].sum() - h) - whole
            if len(won) and won.max() > best[0]:
                best = (float(won.max()), (j, float(cuts[j][int(won.argmax())])))
    if best[1] is None:
        step[rows] += grad[rows].sum() / (hess[rows].sum() + 1.0)
        return
    j, cut = best[1]
    for above in (False, True):
        part = rows[(x[rows, j] > cut) == above]
        longer = (*path, (STATISTICS[j], above, cut))
        if len(part):
            out.append(longer)
            _grow(x, cuts, grad, hess, part, longer, depth + 1, out, step)


def _holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    test = np.ones(len(x), dtype=bool)
    for name, above, cut in rule:
        test &= (x[:, STATISTICS.index(name)] > cut) == above
    return test


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> RuleModel:
    """Learns from statistics and labels 0 and 1. No rows give the score 0.5, a single class its smoothed share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return RuleModel(base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 2)[1:-1], method="lower")) for j in range(x.shape[1])]
    rules: list = []
    log_odds = np.full(len(y), base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-log_odds))
        step = np.zeros(len(y))
        _grow(x, cuts, y - p, p * (1 - p), np.arange(len(y)), (), 0, rules, step)
        log_odds += 0.3 * step
    rules = list(dict.fromkeys(tuple(sorted(set(r))) for r in rules))
    z = np.column_stack([_holds(r, x) for r in rules]).astype(float) if rules else np.zeros((len(y), 0))
    distinct, at = np.unique(z, axis=1, return_index=True) if rules else (z, np.array([], int))
    z, rules = distinct, [rules[i] for i in at]
    # Accelerated proximal gradient; the intercept is not penalised.
    rate = 4.0 / (np.linalg.norm(np.column_stack([np.ones(len(y)), z]), 2) ** 2 / len(y))
    w, b = np.zeros(z.shape[1]), base
    v, c, t = w.copy(), b, 1.0
    for _ in range(1500):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - rate * (z.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        c_new = c - rate * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_new * (new - w), c_new + (t - 1) / t_new * (c_new - b)
        w, b, t = new, c_new, t_new
    keep = np.flatnonzero(w)
    return RuleModel(float(b), [rules[i] for i in keep], [float(w[i]) for i in keep])


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether a row is kept from learning; a null doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(False))


def learn_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Learns from labelled rows (doc_id, quality) outside the held-out part, ``sample_rows`` of them at most.

    Labels that are null or neither 0 nor 1, and those without a document, are not used; several labels of a
    document each count. The sample is sent to every task, as its size is bounded.
    """
    usable = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    stats = with_statistics(rows).orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *STATISTICS).limit(sample_rows)
    table = stats.select("quality", *STATISTICS).toPandas()
    return fit_rules(table[list(STATISTICS)].to_numpy(float), table["quality"].to_numpy(float))


def score_quality(stats: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of statistics."""
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
