"""A small corpus with every odd case, and what the tests read it by."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words long, row string, node string"


def prose(seed: int, n: int) -> str:
    """n invented words, hardly any of them alike in two texts."""
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(4, 9))) for _ in range(n))


def corpus() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, texts without words, a very long one, repeated rows."""
    base, shared = prose(1, 120), prose(2, 60)
    words = base.split()
    near = [" ".join([*words[:i], "changed", *words[i + 1 :]]) for i in (5, 40, 80)]
    texts = [
        (1, base, "a"), (2, base, "b"), (3, near[0], "a"), (4, near[1], None), (5, near[2], "a"), (6, f"{prose(3, 50)} {shared} {prose(4, 40)}", "b"),
        (7, f"{prose(5, 30)} {shared}", "b"), (8, None, "a"), (9, "", None), (10, " \t\n ", "c"), (11, "one two three", "c"), (12, "one two three", "c"), (13, "eins", "c"),
        (14, f"{shared} {prose(6, 20)} {shared}", "é"), (15, prose(7, 60_000), "a"), (16, prose(8, 80), "z"), (16, prose(8, 80), "z"), (17, prose(9, 90), "z"), (17, prose(10, 90), "z"),
        (None, prose(11, 70), "a"), (None, None, None), (18, "ÄÖ  ñandú\u00a0x\u000by", "b"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), 7, "clash", None) for i, t, s in texts]


def words(text):
    return (text or "").encode().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def sorted_rows(df):
    return sorted(rows_of(df), key=repr)
