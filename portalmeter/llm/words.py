"""Words, their hashes and shingles, and tables kept in the shared folder: what several operators here use.

A word is a run of characters other than space and ``\\t \\n \\v \\f \\r``, everywhere in this subpackage.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalmeter.session import shared_dir

GAP = "[\\x20\\x09-\\x0D]+"
SHINGLE = 5

_IS_GAP = np.zeros(256, dtype=bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20


# --- Spark ---------------------------------------------------------------------------------------------------


def words_of(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


class Scratch:
    """Intermediate tables below the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset (a session on one machine, as in
    tests) a temporary folder is made, which goes when the process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        if not spark.conf.get("spark.checkpoint.dir", None):
            local = tempfile.mkdtemp(prefix="llm-")
            atexit.register(shutil.rmtree, local, True)
        else:
            local = None
        self.root = f"{shared_dir(spark, local).rstrip('/')}/llm-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, rows_a_group: int = 0) -> DataFrame:
        """Writes a table once and reads it from there: cuts the lineage, and lost executors lose nothing of it.

        ``rows_a_group``: rows in a row group of a file at most, where rows are large; those of a group are read at once.
        0 leaves it to Spark.
        """
        path = f"{self.root}/{name}"
        to = df.write.mode("overwrite")
        (to.option("parquet.block.row.count.limit", rows_a_group) if rows_a_group else to).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs within this sends rows to Python in batches of about so many bytes, unless the session has its own limit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None):
        yield
        return
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key)


# --- inside tasks --------------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = np.cumprod(np.full(64, _BASE), dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.full(2 * n, _BASE), dtype=np.uint64)
    return _POWERS


def _piece_hashes(buf: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word in a buffer of UTF-8; at breaks a new word begins in any case."""
    inside = ~_IS_GAP[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[breaks] |= inside[breaks]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    opens = np.flatnonzero(first[at])
    sizes = np.diff(np.append(opens, len(at)))
    place = np.arange(len(at)) - np.repeat(opens, sizes)
    values = (buf[at].astype(np.uint64) + np.uint64(1)) * _powers(int(sizes.max()))[place]
    return at[opens], mix(np.add.reduceat(values, opens) + sizes.astype(np.uint64))


def _cuts(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at a gap, so that no word is cut."""
    start = 0
    while len(text) - start > _PIECE:
        end = start + _PIECE
        while end < len(text) and not _IS_GAP[text[end]]:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def word_hashes(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words, worked out about a megabyte at a time."""
    held: list[bytes] = []
    size = 0

    def out() -> Iterator[np.ndarray]:
        ends = np.cumsum([len(t) for t in held])
        buf = np.frombuffer(b"".join(held), dtype=np.uint8)
        starts, hashes = _piece_hashes(buf, (ends[:-1])[ends[:-1] < len(buf)]) if len(buf) else (np.empty(0, np.int64), np.empty(0, np.uint64))
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))

    for text in texts:
        text = text or b""
        if len(text) > _PIECE:
            if held:
                yield from out()
                held, size = [], 0
            none = np.empty(0, dtype=np.int64)
            yield np.concatenate([_piece_hashes(np.frombuffer(p, dtype=np.uint8), none)[1] for p in _cuts(text) if p] or [np.empty(0, np.uint64)])
            continue
        held.append(text)
        size += len(text)
        if size > _PIECE:
            yield from out()
            held, size = [], 0
    if held:
        yield from out()


def window_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of n words; none for shorter texts."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.full(len(words) - n + 1, seed, dtype=np.uint64)
    for i in range(n):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += words[i : i + len(total)]
        total ^= total >> np.uint64(32)
    return mix(total)


def shingle_hashes(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, sorted; a text of fewer words is one shingle, an empty one has none."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(words, min(n, len(words)), seed=0 if len(words) >= n else len(words)))


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column one at a time, as UTF-8."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py()
