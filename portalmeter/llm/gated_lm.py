"""Log-likelihood of whole documents under a gated recurrent language model, and under a smoothed unigram model.

The model is a GRU in numpy with a class-factored output: a class of the next word, then the word within it. The
frequent words are told apart by the network; the others fall into a few spelling classes, within which a word has
its smoothed share of the training tokens, so that every text has a proper probability. Training runs truncated
backpropagation through time over every training document, in all parts of the corpus at once, and averages the
parameters after each round. Scoring carries the state across windows from the first word of a document to its end.

Texts are cut into tokens once: chunks of documents of bounded size keep the numbers of their words, and each word's
hash of 64 bits stands for it from there on. Counts come from every training token. Each chunk gets back the counts of
its own words by a join, so no table of all words is ever sent to a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalmeter.llm.words import Scratch, arrow_batches, mix, text_bytes

FREQUENT, CLASSES, SPELLINGS = 2048, 48, 16
HIDDEN, WINDOW, LANES = 16, 32, 256
CHUNK_CHARS = 9_000_000
#: Every round trains on its share of the training documents, so that all of them are read once in each pass.
ROUNDS, PASSES, STEP = 2, 1, 0.1
#: Parameters that are averaged in one group, so that no group grows with the corpus.
FAN_IN = 32
END = np.uint64(1)

_IS_GAP = np.zeros(256, dtype=bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True
_DIGIT, _BEYOND, _SIGN = 1, 2, 4
_FLAGS = np.full(256, _SIGN, np.uint8)
_FLAGS[ord("a") : ord("z") + 1] = 0
_FLAGS[ord("0") : ord("9") + 1] = _DIGIT
_FLAGS[0x80:] = _BEYOND
#: A random factor for each place of a word; they come round after 256 places, with the turn mixed in.
_FACTORS = np.random.default_rng(2).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only), then the end."""
    words = (text or "").encode().lower().split()
    words.append(b"\n")
    return words


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and spelling classes of the tokens of texts, end to end, and where each text's tokens end.

    A key is a hash of the word; that of the end is ``END``. The spelling class of a word tells its length and whether
    it has digits, letters beyond a-z, or other signs.
    """
    buf = np.frombuffer(b"\n".join([t.lower() for t in texts]) + b"\n", np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    at = np.flatnonzero(~_IS_GAP.take(buf))
    opens = np.flatnonzero(np.append(True, np.diff(at) > 1)) if len(at) else np.empty(0, np.int64)
    owner = np.searchsorted(text_ends, at[opens], side="right")
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)) + 1)
    keys, spell = np.full(int(ends[-1]), END, np.uint64), np.zeros(int(ends[-1]), np.int8)
    if len(opens):
        size, signs = np.diff(np.append(opens, len(at))), buf.take(at)
        place = np.arange(len(at)) - np.repeat(opens, size)
        values = signs.astype(np.uint64)
        values += np.uint64(1)
        if size.max() > 256:
            values += (place >> 8).astype(np.uint64) << np.uint64(9)
            place &= 255
        values *= _FACTORS.take(place)
        flags = np.bitwise_or.reduceat(_FLAGS.take(signs), opens)
        kind = np.where(flags & _SIGN, 3, np.where(flags & _BEYOND, 2, flags & _DIGIT))
        where = np.arange(len(opens)) + owner
        keys[where] = np.maximum(mix(np.add.reduceat(values, opens) + size.astype(np.uint64)), END + np.uint64(1))
        spell[where] = 4 * kind + np.minimum(size // 4, 3)
    return keys, spell, ends


# --- the network ---------------------------------------------------------------------------------------------


class Vocabulary:
    """Frequent words in classes of about equal weight, and the counts that rare words are shared out by.

    Ids 0.. are the frequent words in order of class; those after them stand for the classes of rare words. ``words``
    are pairs of key and count, ``rare`` the tokens and words of each spelling class that are not frequent.
    """

    def __init__(self, words: list[tuple[int, int]], rare: dict[int, tuple[int, int]], total: int, distinct: int):
        self.total, self.distinct = total, distinct
        weight = np.sqrt([c for _, c in words] or [1])
        slot = np.minimum((np.cumsum(weight) - weight) / weight.sum() * CLASSES, CLASSES - 1).astype(int) if words else np.zeros(0, int)
        self.edges = [int(x) for x in np.searchsorted(slot, np.arange(CLASSES + 1))]
        self.class_of = np.concatenate([slot, CLASSES + np.arange(SPELLINGS)]).astype(np.int64)
        self.rare = rare
        self.n = len(words)
        self.counts = np.array([c for _, c in words], np.int64)
        keys = np.array([k for k, _ in words], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        unigram = np.array([c for _, c in words] + [rare.get(s, (0, 0))[0] + 1.0 for s in range(SPELLINGS)])
        mass = np.bincount(self.class_of, unigram, CLASSES + SPELLINGS)
        self.class_bias = np.log(np.maximum(mass, 0.5) / max(mass.sum(), 1)).astype(np.float32)
        self.word_bias = np.log(unigram[: self.n] / mass[slot]).astype(np.float32) if words else np.zeros(0, np.float32)

    def frequent(self, keys: np.ndarray) -> np.ndarray:
        """The ids of keys, -1 for rare words."""
        if not self.n:
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), self.n - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)

    def ids(self, keys: np.ndarray, spell: np.ndarray) -> np.ndarray:
        found = self.frequent(keys)
        return np.where(found >= 0, found, self.n + spell)

    @property
    def start(self) -> int:
        """What is read before the first word: the end of a text."""
        return int(self.ids(np.array([END]), np.zeros(1, np.int64))[0])

    def rare_log(self, spell: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The natural logarithms of rare words' shares within their classes."""
        n, v = (np.array([self.rare.get(s, (0, 0))[i] for s in range(SPELLINGS)], np.float64) for i in (0, 1))
        return np.log((counts + 0.1) / (n + 0.1 * (v + 1))[spell])


def shapes(n: int) -> dict[str, tuple[int, ...]]:
    h = HIDDEN
    return {"inputs": (n + SPELLINGS, 3 * h), "gates": (h, 3 * h), "gate_bias": (3 * h,), "class_out": (h, CLASSES + SPELLINGS), "class_bias": (CLASSES + SPELLINGS,), "word_out": (n, h), "word_bias": (n,)}


def initial(vocabulary: Vocabulary, seed: int = 1) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    out = {k: (random.standard_normal(s) * 0.1).astype(np.float32) for k, s in shapes(vocabulary.n).items()}
    out["gate_bias"][:] = 0
    out["class_bias"], out["word_bias"] = vocabulary.class_bias.copy(), vocabulary.word_bias.copy()
    return out


def _step(read: np.ndarray, gates: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The next state from what the words read put in and the last state; also what the backward pass needs.

    That is the update and reset gates side by side, the new content, and what the last state gives to it.
    """
    n = HIDDEN
    back = h @ gates
    both = read[:, : 2 * n] + back[:, : 2 * n]
    # The logistic function by way of tanh, which neither overflows nor makes copies.
    both *= np.float32(0.5)
    np.tanh(both, out=both)
    both += np.float32(1)
    both *= np.float32(0.5)
    new = both[:, n:] * back[:, 2 * n :]
    new += read[:, 2 * n :]
    np.tanh(new, out=new)
    step = new - h
    step *= both[:, :n]
    step += h
    return step, both, new, back[:, 2 * n :]


#: Exponentials of numbers below this fit into 32 bits, and so do sums of many of them.
_SAFE = 70.0


def _softmax(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, at: np.ndarray, safe: bool, grad: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The logarithm of the probability of a place for each state; with ``grad`` also adds gradients and gives those of h.

    ``safe`` tells that no sum of products can be so large that its exponential overflows. The factor that a row's
    gradients have in common is put on the short side of each product.
    """
    x, rows = h @ weights, np.arange(len(h))
    x += bias
    if not safe:
        x -= x.max(axis=1, keepdims=True)
    mine = x[rows, at]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    out = mine - np.log(total)
    if grad is None:
        return out, None
    x[rows, at] -= total
    share = (-1 / total)[:, None]
    grad[0][...] += (h * share).T @ x
    grad[1][...] += share[:, 0] @ x
    back = x @ weights.T
    back *= share
    return out, back


def _is_safe(reach: float, weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether sums of products with states whose parts are at most ``reach`` stay in bounds; states are rows."""
    return bool(reach * np.abs(weights).sum(axis=0).max(initial=0) + np.abs(bias).max(initial=0) < _SAFE)


def log_outputs(p: dict[str, np.ndarray], v: Vocabulary, h: np.ndarray, target: np.ndarray, grad: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """The log-probability of each target after each state; with ``grad`` also adds gradients and gives those of h."""
    classes = v.class_of[target]
    # In order of class, so that each class is one stretch.
    order = np.argsort(classes.astype(np.int16), kind="stable")
    classes, target, h = classes[order], target[order], h.take(order, axis=0)
    reach = float(np.abs(h).max(initial=0))
    safe, sums = _is_safe(reach, p["class_out"], p["class_bias"]), grad and (grad["class_out"], grad["class_bias"])
    log, back = _softmax(h, p["class_out"], p["class_bias"], classes, safe, sums)
    cuts = np.searchsorted(classes, np.arange(CLASSES + 1))
    safe = _is_safe(reach, p["word_out"].T, p["word_bias"])
    for c in np.flatnonzero(np.diff(cuts)):
        lo, hi = v.edges[c], v.edges[c + 1]
        if hi - lo < 2:
            continue
        mine = slice(cuts[c], cuts[c + 1])
        more, d = _softmax(h[mine], p["word_out"][lo:hi].T, p["word_bias"][lo:hi], target[mine] - lo, safe, grad and (grad["word_out"][lo:hi].T, grad["word_bias"][lo:hi]))
        log[mine] += more
        if grad is not None:
            back[mine] += d
    out = np.empty_like(log)
    out[order] = log
    if grad is None:
        return out, None
    down = np.empty_like(back)
    down[order] = back
    return out, down


def _columns(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in order of falling length, end to end: their order, lengths and starts."""
    sizes = np.array([len(d) for d in documents])
    order = np.argsort(-sizes, kind="stable")
    return order, sizes[order], (np.cumsum(sizes) - sizes)[order]


def score_documents(p: dict[str, np.ndarray], v: Vocabulary, documents: list[np.ndarray], start: int) -> np.ndarray:
    """The natural log-likelihood of each sequence of ids; ``start`` is what is read before the first word."""
    order, sizes, starts = _columns(documents)
    flat = np.concatenate(documents)
    total = np.zeros(len(documents))
    h = np.zeros((len(documents), HIDDEN), np.float32)
    last = np.full(len(documents), start)
    inputs = p["inputs"] + p["gate_bias"]
    t = 0
    while t < sizes[0]:
        states, owners, targets, held = [], [], [], 0
        while t < sizes[0] and held < 8_000 and len(states) < 512:
            live = int(np.searchsorted(-sizes, -t, side="left"))
            h = _step(inputs.take(last[:live], axis=0), p["gates"], h[:live])[0]
            last = flat[starts[:live] + t]
            states.append(h)
            owners.append(np.arange(live))
            targets.append(last)
            held += live
            t += 1
        log, _ = log_outputs(p, v, np.concatenate(states), np.concatenate(targets))
        total += np.bincount(np.concatenate(owners), log, len(documents))
    out = np.empty(len(documents))
    out[order] = total
    return out


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row to the row of the table it belongs to."""
    order = np.argsort(at.astype(np.int16), kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    table[at[first]] += np.add.reduceat(rows.take(order, axis=0), first, axis=0)


def train_documents(p: dict[str, np.ndarray], v: Vocabulary, documents: list[np.ndarray], start: int, passes: int = PASSES) -> dict[str, np.ndarray]:
    """Parameters after some passes over documents: backpropagation through WINDOW words at a time.

    The documents stand end to end and are cut into LANES of equal length, which are read side by side; the state
    goes on from window to window and starts anew where a document does.
    """
    p = {k: x.copy() for k, x in p.items()}
    speed = {k: np.full_like(x, 0.1) for k, x in p.items()}
    flat, n = np.concatenate(documents), HIDDEN
    fresh = np.zeros(len(flat), bool)
    fresh[np.cumsum([0, *map(len, documents[:-1])])] = True
    read = np.where(fresh, start, np.append(start, flat[:-1]))
    length = -(-len(flat) // LANES)
    lanes = -(-len(flat) // length)
    # The last lane may be shorter; what is missing has no weight.
    at = np.arange(lanes)[:, None] * length + np.arange(length)
    there = at < len(flat)
    at = np.minimum(at, len(flat) - 1)
    for _ in range(passes):
        h = np.zeros((lanes, n), p["gates"].dtype)
        for begin in range(0, length, WINDOW):
            now = np.ascontiguousarray(at[:, begin : begin + WINDOW].T)
            steps, keep, starts = len(now), there[:, begin : begin + WINDOW].T.ravel(), fresh[now]
            some, words = starts.any(axis=1), read[now].ravel()
            put = p["inputs"].take(words, axis=0)
            put += p["gate_bias"]
            put = put.reshape(steps, lanes, 3 * n)
            before, after, new, back = (np.empty((steps, lanes, n), h.dtype) for _ in range(4))
            both = np.empty((steps, lanes, 2 * n), h.dtype)
            for t in range(steps):
                before[t] = h
                if some[t]:
                    before[t, starts[t]] = 0
                h, both[t], new[t], back[t] = _step(put[t], p["gates"], before[t])
                after[t] = h
            grad = {k: np.zeros_like(x) for k, x in p.items()}
            _, found = log_outputs(p, v, after.reshape(-1, n)[keep], flat[now].ravel()[keep], grad)
            down = np.zeros((steps * lanes, n), h.dtype)
            down[keep] = found
            down = down.reshape(steps, lanes, n)
            # What a state's gradient is multiplied by on its way to the gates and to the content, for all steps at once.
            update, reset = both[..., :n], both[..., n:]
            to_new = update * (1 - new * new)
            factors = np.empty((steps, lanes, 3, n), h.dtype)
            factors[:, :, 0] = (new - before) * update * (1 - update)
            np.multiply(to_new, reset, out=factors[:, :, 2])
            factors[:, :, 1] = factors[:, :, 2] * back * (1 - reset)
            past = 1 - update
            inner, gates_up = np.empty_like(factors), np.ascontiguousarray(p["gates"].T)
            carried = np.zeros((lanes, n), h.dtype)
            for t in range(steps - 1, -1, -1):
                d = down[t]
                d += carried
                np.multiply(d[:, None], factors[t], out=inner[t])
                carried = inner[t].reshape(lanes, 3 * n) @ gates_up
                carried += d * past[t]
                if some[t]:
                    carried[starts[t]] = 0
            flat_inner = inner.reshape(-1, 3 * n)
            grad["gates"] += before.reshape(-1, n).T @ flat_inner
            # The words read reach the content past the reset gate.
            np.multiply(down, to_new, out=inner[:, :, 2])
            _add_rows(grad["inputs"], words, flat_inner)
            grad["gate_bias"] += flat_inner.sum(axis=0)
            size = max(1, int(keep.sum())) ** 0.5
            for k, g in grad.items():
                g /= size
                np.clip(g, -1, 1, out=g)
                speed[k] += g * g
                g /= np.sqrt(speed[k])
                g *= STEP
                p[k] += g
    return p


def _pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32)


def _unpack(flat: np.ndarray, n: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(shapes(n)):
        shape = shapes(n)[k]
        size = math.prod(shape)
        out[k] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


# --- Spark ---------------------------------------------------------------------------------------------------

_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("has_id", pa.list_(pa.bool_())), ("held", pa.list_(pa.bool_())), ("ends", pa.list_(pa.int32())), ("ids", pa.binary()), ("keys", pa.binary()),
     ("spell", pa.binary()), ("n", pa.binary())]
)
_CHUNK_DDL = "chunk long, doc_id array<long>, has_id array<boolean>, held array<boolean>, ends array<int>, ids binary, keys binary, spell binary, n binary"
#: What has a number for each token or word of a chunk is packed: as arrays, a chunk's row and the copies that Spark makes
#: of it while it is read, moved and sent to Python take several times the memory.
_PACKED = {"ids": np.int32, "keys": np.uint64, "spell": np.int8, "n": np.int32}
#: Bytes of chunks that are sent to Python at once, a chunk at least.
BATCH_BYTES = 4 << 20


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes: how many there are, then the lowest byte of each, the next byte of each and so on, compressed."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes | pa.Buffer, dtype: type) -> np.ndarray:
    """The numbers that ``packed`` was given."""
    data, kind = memoryview(data), np.dtype(dtype)
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=n * kind.itemsize, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def _chunks(chunk_chars: int):
    """Documents (doc_id, held_out, text) as chunks: their words by number, and the words with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            doc_id, held_out, keys, spell = zip(*held, strict=True)
            ends = np.cumsum([len(k) for k in keys])
            every = np.concatenate(keys)
            unique, first, ids = np.unique(every, return_index=True, return_inverse=True)
            learnt = np.repeat(~np.array(held_out), [len(k) for k in keys])
            n = np.bincount(ids[learnt], minlength=len(unique))
            # Frequent words get small numbers, which are packed best.
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            numbers = rank[ids], unique[order], np.concatenate(spell)[first[order]], n[order].astype(np.int32)
            row = [base + number, [i or 0 for i in doc_id], [i is not None for i in doc_id], held_out, ends, *map(packed, numbers)]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _CHUNK, strict=True)], schema=_CHUNK)

        for batch in batches:
            # A few texts at a time, whose arrays stay in the processor's cache.
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                texts = list(text_bytes(part.column(2)))
                keys, spell, ends = hashed(texts)
                cuts = ends[:-1]
                held += zip(part.column(0).to_pylist(), part.column(1).to_pylist(), np.split(keys, cuts), np.split(spell, cuts), strict=True)
                size += sum(map(len, texts))
                if size >= chunk_chars:
                    yield out()
                    held, size, number = [], 0, number + 1
        if held:
            yield out()

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of chunks (keys, spell, n) that stand in training texts."""
    for batch in batches:
        for row in _rows(batch):
            seen = row["n"] > 0
            columns = [row["keys"].view(np.int64)[seen], row["spell"][seen].astype(np.int32), row["n"][seen].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "spell", "n"])


_BLOCK = 8192
_PARTS = "member long, block int, weight double, values array<float>"


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.asarray(v, np.float64) * w for v, w in zip(pdf["values"], pdf["weight"], strict=True))
    weight = pdf["weight"].sum()
    return pd.DataFrame({"member": [pdf["member"].iloc[0] // FAN_IN], "block": [pdf["block"].iloc[0]], "weight": [weight], "values": [(total / weight).astype(np.float32)]})


def train_model(chunks: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters after ``rounds`` over the training documents of chunks, each document in one of them.

    In a round the chunks that one task has made are read one after another, going on from the mean of the round before,
    and give one set of parameters. These are averaged by the tokens they have seen, in a tree of groups of FAN_IN.
    """
    flat = _pack(initial(vocabulary))
    if not vocabulary.n:
        return flat
    send = chunks.sparkSession.sparkContext.broadcast
    held = send(vocabulary)

    def trained_from(now, turn: int):
        def result(member: int, p: dict[str, np.ndarray], size: int) -> pa.RecordBatch:
            parts = np.array_split(_pack(p), max(1, len(now.value) // _BLOCK))
            n = len(parts)
            columns = [pa.array([member] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([float(size)] * n), pa.array(parts, pa.list_(pa.float32()))]
            return pa.RecordBatch.from_arrays(columns, names=["member", "block", "weight", "values"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v, member, p, size = held.value, -1, {}, 0
            for batch in batches:
                for row in _rows(batch):
                    if row["chunk"] >> 32 != member:
                        if size:
                            yield result(member, p, size)
                        member, p, size = row["chunk"] >> 32, _unpack(now.value, v.n), 0
                    every = v.ids(row["keys"], row["spell"].astype(np.int64))[row["ids"]]
                    documents = np.split(every, row["ends"][:-1])
                    mine = [d for i, (d, out) in enumerate(zip(documents, row["held"], strict=True)) if not out and i % rounds == turn]
                    if mine:
                        p = train_documents(p, v, mine, v.start)
                        size += sum(map(len, mine))
            if size:
                yield result(member, p, size)

        return run

    members = (chunks.agg(F.max("chunk")).first()[0] or 0) // 2**32 + 1
    for turn in range(rounds):
        mean = chunks.select("chunk", "held", "ends", "ids", "keys", "spell").mapInArrow(trained_from(send(flat), turn), _PARTS)
        for _ in range(max(1, math.ceil(math.log(members, FAN_IN)) if members > 1 else 1)):
            mean = mean.groupBy("block", F.floor(F.col("member") / FAN_IN)).applyInPandas(_average, _PARTS)
        # The parameters of tasks go straight to their groups, not by way of a small file for each task.
        with arrow_batches(chunks.sparkSession, BATCH_BYTES):
            rows = sorted(mean.select("block", "values").collect())
        if rows:
            flat = np.concatenate([np.asarray(r[1], np.float32) for r in rows])
    return flat


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of chunks in a batch: the chunk's number, and arrays."""

    def value(name: str, x: pa.Scalar) -> int | np.ndarray:
        if name == "chunk":
            return x.as_py()
        return unpacked(x.as_buffer(), _PACKED[name]) if name in _PACKED else x.values.to_numpy(zero_copy_only=False)

    for i in range(batch.num_rows):
        yield {name: value(name, batch.column(name)[i]) for name in batch.schema.names}


def lm_scores(docs: DataFrame, scratch: Scratch, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs (doc_id, text, ...).

    Rows whose crc32 of the doc_id's text is divisible by 10 are held out: nothing is learnt from them. Scores are
    sums of log10 of probabilities over all tokens of the whole text, its end included. A null text counts as empty;
    a null doc_id is not held out; repeated rows are scored, and counted, each. No rows give none. Other columns are
    ignored.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = scratch.save(plain.mapInArrow(_chunks(chunk_chars), _CHUNK_DDL), "chunks", rows_a_group=1)

    local = chunks.select("keys", "spell", "n").mapInArrow(_word_counts, "key long, spell int, n long")
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        # In few files: there are far fewer words than rows that are added up.
        added = local.groupBy("key").agg(F.max("spell").alias("spell"), F.sum("n").alias("c"))
        counts = scratch.save(added.hint("rebalance"), "counts")
    top = counts.orderBy(F.desc("c"), "key").limit(FREQUENT).collect()
    least = (top[-1]["c"], top[-1]["key"]) if top else (0, 0)
    below = counts.where((F.col("c") < least[0]) | (F.col("c") == least[0]) & (F.col("key") > least[1]))
    rare = {r["spell"]: (r["n"], r["v"]) for r in below.groupBy("spell").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    whole = counts.agg(F.sum("c"), F.count("*")).first()
    vocabulary = Vocabulary([(r["key"] % 2**64, r["c"]) for r in top], rare, whole[0] or 0, whole[1])
    flat = train_model(chunks, vocabulary)
    send = docs.sparkSession.sparkContext.broadcast
    held, parameters = send(vocabulary), send(flat)

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                at = np.flatnonzero(held.value.frequent(row["keys"]) < 0)
                # A word's place in the chunk and its training count there, in one number.
                both = (at << 32) | row["n"][at].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["chunk"])), pa.array(both), pa.array(row["keys"].view(np.int64)[at])], names=["own", "packed", "key"])

    wanted = chunks.select("chunk", "keys", "n").mapInArrow(rare_words, "own long, packed long, key long")
    # Most rare words stand in one chunk alone: the count it has itself is right.
    other = wanted.join(counts.select("key", "c"), "key").where(F.col("c") != F.col("packed").bitwiseAND(F.lit(2**32 - 1)))
    found = other.select("own", F.shiftright("packed", 32).cast("int").alias("place"), "c")

    def score(chunk: pd.DataFrame, counts_of: pd.DataFrame) -> pd.DataFrame:
        v, row = held.value, chunk.iloc[0]
        p = _unpack(parameters.value, v.n)
        keys, spell, texts, n = (unpacked(row[k], _PACKED[k]).astype(t, copy=False) for k, t in (("keys", np.uint64), ("spell", np.int64), ("ids", np.int32), ("n", np.int64)))
        ends = row["ends"]
        frequent = v.frequent(keys)
        is_rare = frequent < 0
        known = np.where(is_rare, n, v.counts[frequent] if v.n else 0)
        if len(counts_of):
            known[counts_of["place"].to_numpy()] = counts_of["c"].to_numpy()
        within = np.where(is_rare, v.rare_log(spell, known), 0.0)
        base = np.log(known + 0.1) - math.log(v.total + 0.1 * (v.distinct + 1))
        begins = np.append(0, ends[:-1])
        sums = lambda values: np.add.reduceat(values[texts], begins)
        log = score_documents(p, v, np.split(v.ids(keys, spell)[texts], ends[:-1]), v.start)
        return pd.DataFrame(
            {"doc_id": pd.arrays.IntegerArray(np.array(row["doc_id"], np.int64), ~row["has_id"].astype(bool)),
             "held_out": row["held"].astype(bool), "n_tokens": ends - begins, "n_known": sums((known > 0).astype(np.int64)), "train_tokens": v.total,
             "base_score": sums(base) / math.log(10), "score": (log + sums(within)) / math.log(10)}
        )

    sides = chunks.select("chunk", "doc_id", "has_id", "held", "ends", "ids", "keys", "spell", "n").groupBy("chunk").cogroup(found.groupBy("own"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return sides.applyInPandas(score, schema)
