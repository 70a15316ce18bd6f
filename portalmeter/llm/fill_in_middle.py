"""Fill-in-the-middle rewriting of texts: two cuts at unit boundaries, found in a wavelet matrix over character classes.

A character is one of four classes: a line feed, other white space, a mark that ends a sentence, or anything else. The
wavelet matrix holds the two bits of the classes as two bit vectors with counts of ones per block, so the rank of a
class (how often it stands before a place) takes two counts. The ranks of the classes that end a unit (line, word or
sentence) add up to the number of boundaries before a place, and bisection on these finds where the k-th unit ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER, SPACE, STOP, FEED = range(4)
#: The classes after whose characters a unit ends.
UNITS = {"line": (FEED,), "word": (FEED, SPACE), "sentence": (FEED, STOP)}
SENTINELS = ("<P>", "<S>", "<M>")

_CLASSES = np.zeros(256, np.uint8)
_CLASSES[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = SPACE
_CLASSES[[ord(c) for c in ".!?"]] = STOP
_CLASSES[0x0A] = FEED


class BitVector:
    """Bits with the number of ones before each block of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, place: int) -> int:
        """How many ones stand before a place."""
        block = place >> 6
        return int(self.before[block]) + (int(self.words[block]) & ((1 << (place & 63)) - 1)).bit_count()


class WaveletMatrix:
    """Classes 0 to 3 of a sequence: the high bits, then the low bits of the classes in stable order of the high bit."""

    def __init__(self, classes: np.ndarray):
        self.size = len(classes)
        high = classes >> 1
        low = np.concatenate([classes[high == 0], classes[high == 1]]) & 1
        self.levels = (BitVector(high), BitVector(low))
        self.zeros = tuple(self.size - level.rank(self.size) for level in self.levels)
        self.starts = [self._down(c, 0) for c in range(4)]

    def _down(self, symbol: int, place: int) -> int:
        for shift, level, zeros in ((1, self.levels[0], self.zeros[0]), (0, self.levels[1], self.zeros[1])):
            ones = level.rank(place)
            place = zeros + ones if symbol >> shift & 1 else place - ones
        return place

    def rank(self, symbol: int, place: int) -> int:
        """How often a class stands before a place."""
        return self._down(symbol, place) - self.starts[symbol]


class Boundaries:
    """The units of a text: its boundaries, and the rest behind the last one."""

    def __init__(self, text: str, unit: str = "line"):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        classes = np.where(codes < 256, _CLASSES[np.minimum(codes, 255)], OTHER).astype(np.uint8)
        self.matrix, self.ends = WaveletMatrix(classes), UNITS[unit]
        self.full = self.before(self.matrix.size)
        closed = self.matrix.size == 0 or int(classes[-1]) in self.ends
        self.n = self.full + (not closed)

    def before(self, place: int) -> int:
        return sum(self.matrix.rank(c, place) for c in self.ends)

    def end_of(self, units: int) -> int:
        """The place behind so many units, by bisection on the ranks."""
        if units <= 0:
            return 0
        if units > self.full:
            return self.matrix.size
        low, high = 0, self.matrix.size
        while low < high:
            middle = (low + high) // 2
            if self.before(middle) >= units:
                high = middle
            else:
                low = middle + 1
        return low


def rewrite(text: str, digest: str, rate: int, spm: int, unit: str, sentinels: tuple[str, str, str]) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of a text; the digest is what the four numbers are read from."""
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    found = Boundaries(text, unit)
    if not text or any(s in text for s in sentinels) or h3 % 100 >= rate:
        return found.n, "plain", None, None, text
    first, second = sorted((h1 % (found.n + 1), h2 % (found.n + 1)))
    a, b = found.end_of(first), found.end_of(second)
    p, s, m = sentinels
    if h4 % 100 < spm:
        return found.n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return found.n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = "line", sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of docs (doc_id, text, ...).

    ``n`` is the number of units (lines, words or sentences with what ends them). Both cuts, whether a text is
    rewritten (``rate`` of 100) and its form (``spm`` of 100 suffix first) come from the SHA-256 of ``seed:doc_id``.
    Empty texts and those that hold a sentinel stay plain, without counts of characters. A null text counts as empty;
    a null doc_id reads as no text behind the colon. Rows are independent of each other, so repeated rows give equal
    results; no rows give none; other columns are ignored. A text is held whole in one task, in about ten times its
    characters.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows = [rewrite(t.as_py(), d.as_py(), rate, spm, unit, sentinels) for t, d in zip(part.column(1), part.column(2), strict=True)]
                n, form, prefix, middle, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    return plain.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made from; the sentinels must hold no signs special to patterns but ``<`` and ``>``."""
    part = F.split(output, "|".join(sentinels), -1)
    whole = F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1]))
    return F.when(form == "plain", output).otherwise(whole)
