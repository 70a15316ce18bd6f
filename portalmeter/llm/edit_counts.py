"""Token counts that follow edits: a segment tree per document, of which an edit re-encodes only what it touches.

A text is cut into pre-tokens by the tokenizer's pattern; its tokens are those of its pre-tokens. A run of ``LEAF``
pre-tokens is a leaf of the tree and holds its characters and tokens; inner nodes hold sums. An edit goes down to
its leaf by characters, re-encodes from that leaf's start (or an earlier one, if the text just before the edit may
have been read differently) until a pre-token begins where a leaf began, and changes the sums above. The pattern
looks at most a few characters ahead and never back, so from there on nothing differs.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A tiktoken vocabulary, one base64 token and its rank a line, and the pattern of its pre-tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF, AHEAD = 64, 4
_REMEMBERED = 200_000


class Counter:
    """How many tokens a pre-token has. Pre-tokens seen before are looked up; the memory of them is bounded."""

    def __init__(self, vocabulary: str, pattern: str):
        import regex
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.known: dict[str, int] = {}

    def tokens(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                if len(known) >= _REMEMBERED:
                    known.clear()
                n = known[piece] = len(self.encode(piece))
            out.append(n)
        return out


@lru_cache(maxsize=2)
def counter(vocabulary: str, pattern: str) -> Counter:
    return Counter(vocabulary, pattern)


class SegmentTree:
    """Sums of characters and tokens over leaves; ``splice`` puts new leaves in the place of some."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.levels = [(chars or [0], tokens or [0])]
        self._raise(0)

    def _raise(self, level: int) -> None:
        del self.levels[level + 1 :]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(tuple([sum(x[i : i + 8]) for i in range(0, len(x), 8)] for x in self.levels[-1]))

    @property
    def n_chars(self) -> int:
        return self.levels[-1][0][0]

    @property
    def n_tokens(self) -> int:
        return self.levels[-1][1][0]

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins; the last leaf for what is past the end."""
        at, begin = 0, 0
        for chars, _ in reversed(self.levels[:-1]):
            at *= 8
            last = min(at + 8, len(chars)) - 1
            while at < last and char >= begin + chars[at]:
                begin += chars[at]
                at += 1
        return at, begin

    def splice(self, lo: int, hi: int, chars: list[int], tokens: list[int]) -> None:
        base = self.levels[0]
        if len(chars) == hi - lo:
            # The same number of leaves: only the sums above them change.
            base[0][lo:hi], base[1][lo:hi] = chars, tokens
            for below, above in zip(self.levels, self.levels[1:], strict=False):
                lo, hi = lo // 8, (max(hi, lo + 1) - 1) // 8 + 1
                for node in range(lo, hi):
                    for x, y in zip(below, above, strict=True):
                        y[node] = sum(x[8 * node : 8 * node + 8])
            return
        base[0][lo:hi], base[1][lo:hi] = chars, tokens
        if not base[0]:
            base[0].append(0)
            base[1].append(0)
        self._raise(0)


class EditableCount:
    """A text with its tree."""

    def __init__(self, text: str, count: Counter, leaf: int = LEAF):
        self.text, self.count, self.leaf = text, count, leaf
        self.tree = SegmentTree(*self._leaves(count.pattern.findall(text)))
        self.encoded = 0

    def _leaves(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        sizes, tokens, n = list(map(len, pieces)), self.count.tokens(pieces), self.leaf
        return [sum(sizes[i : i + n]) for i in range(0, len(sizes), n)], [sum(tokens[i : i + n]) for i in range(0, len(tokens), n)]

    def edit(self, start: int, length: int, new: str) -> None:
        """Puts ``new`` in the place of ``length`` characters; what is outside the text is cut off."""
        start = min(max(start, 0), len(self.text))
        end = min(start + max(length, 0), len(self.text))
        lo, begin = self.tree.leaf_at(max(0, start - AHEAD))
        self.text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        # Places, in the new text, where a leaf of unchanged text begins.
        chars = self.tree.levels[0][0]
        hi, edge = self.tree.leaf_at(end)
        while edge < end and hi < len(chars):
            edge += chars[hi]
            hi += 1
        pieces = []
        for found in self.count.pattern.finditer(self.text, begin):
            at = found.start() - shift
            while hi < len(chars) and edge < at:
                edge += chars[hi]
                hi += 1
            if hi < len(chars) and at == edge and found.start() >= start + len(new):
                break
            pieces.append(found[0])
        else:
            hi = len(chars)
        self.encoded += sum(map(len, pieces))
        self.tree.splice(lo, hi, *self._leaves(pieces))


def derived_edits(text: Column, doc_id: Column, edits: int = 3) -> Column:
    """Edits for a text from its own characters: at hashed places a few are taken out and some from elsewhere put in."""
    n = F.length(text)
    place = lambda i, salt: F.pmod(F.xxhash64(doc_id, F.lit(i), F.lit(salt)), F.greatest(n, F.lit(1))).cast("int")
    one = lambda i: F.struct(
        place(i, 1).alias("start"), (F.pmod(F.xxhash64(doc_id, F.lit(i), F.lit(2)), F.lit(12))).cast("int").alias("length"),
        F.substring(text, place(i, 3) + 1, F.pmod(F.xxhash64(doc_id, F.lit(i), F.lit(4)), F.lit(20)).cast("int")).alias("new"),
    )
    return F.array(*[one(i) for i in range(edits)])


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_chars, n_tokens, n_edits, edited_chars, edited_tokens, encoded_chars, leaf_tokens) for each row of docs.

    docs has doc_id, text and edits: an array of (start, length, new), each on the text that the ones before it left;
    null is no edit, and a null ``new`` is empty. ``encoded_chars`` is what the edits made it encode again;
    ``leaf_tokens`` are the leaves of the tree afterwards. A null or empty text has no tokens. Rows are independent
    of each other; other columns are ignored. ``vocabulary`` is a file that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows = []
                for text, edits in zip(part.column(1), part.column(2), strict=True):
                    state = EditableCount(text.as_py() or "", count, leaf)
                    before = (state.tree.n_chars, state.tree.n_tokens)
                    changes = edits.as_py() or []
                    for e in changes:
                        state.edit(e["start"] or 0, e["length"] or 0, e["new"] or "")
                    rows.append((*before, len(changes), state.tree.n_chars, state.tree.n_tokens, state.encoded, state.tree.levels[0][1]))
                columns = list(zip(*rows, strict=True))
                names = ["n_chars", "n_tokens", "n_edits", "edited_chars", "edited_tokens", "encoded_chars"]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in columns[:6]], pa.array(columns[6], pa.list_(pa.int32()))], names=["doc_id", *names, "leaf_tokens"]
                )

    plain = docs.select(F.col("doc_id").cast("long"), "text", "edits")
    schema = "doc_id long, n_chars long, n_tokens long, n_edits long, edited_chars long, edited_tokens long, encoded_chars long, leaf_tokens array<int>"
    return plain.mapInArrow(run, schema)
