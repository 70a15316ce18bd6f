"""Repairs the structure of conversations at least cost; of equally cheap repairs the one of the least audit wins.

A repair keeps, re-roles or deletes each row and may insert rows; its audit is the initials of these edits in order.
Edits are the edges of a graph whose nodes are (row, last role given). The weight of a path is one integer: its cost in
the high digits and below it, in a fixed number of octal digits, its audit's letters from the left, with zeros behind
the last. The plain minimum of these integers, taken from the end of a conversation backward, so decides both: an edit
before a path moves the path's letters one digit to the right and puts its own in front.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length is spread over tasks. Those that lie
within one task and have at most BLOCK rows are repaired there. The others are cut into pieces of at most BLOCK rows;
each piece gives the least weights between any two states at its ends, and what is joined per conversation are these.
Two paths of a piece with equal ends and cost never have audits of which one begins the other, as the rest of the
longer one would be insertions, which cost something; so the least of a piece is part of the least of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalmeter.llm.words import Scratch

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
#: Rows that are repaired at once.
BLOCK = 512

GAP = " \t\n\x0b\x0c\r"
LEGAL = frozenset(("su", "ua", "au"))
#: Letters in the order of their codes.
LETTERS = "DIKR"
_DIGITS, _BITS = str.maketrans(LETTERS, "1234"), 3
_LETTERS = str.maketrans("1234", LETTERS)

# The last role given: none yet, system, user, assistant. After each of them one role can follow; only none may also be
# followed by a system row that is kept.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLES, INITIALS = ("", "system", "user", "assistant"), ("", "s", "u", "a")


# --- faults --------------------------------------------------------------------------------------------------


def is_blank(text: str) -> bool:
    return not text.strip(GAP)


def is_unfinished(text: str) -> bool:
    return text.rstrip(GAP)[-1:] not in (".", "!", "?")


def faults(rows: list[tuple[str, str]], repeated: list[bool]) -> list[str]:
    """The first fault of each row (role, text), or no text."""
    return ["blank" if is_blank(t) else "duplicate" if r else "truncated" if is_unfinished(t) else "" for (_, t), r in zip(rows, repeated, strict=True)]


def repeats(rows: list[tuple[str, str]]) -> list[bool]:
    seen: set = set()
    return [row in seen or bool(seen.add(row)) for row in rows]


# --- the graph -----------------------------------------------------------------------------------------------


class Weights:
    """Integers that hold a cost and an audit of at most ``width`` letters."""

    def __init__(self, width: int):
        self.width, self.shift = width, _BITS * width
        self.mask = (1 << self.shift) - 1
        self.first = {letter: int(letter.translate(_DIGITS)) << (self.shift - _BITS) for letter in LETTERS}

    def before(self, letter: str, cost: int, rest: int | None) -> int | None:
        """The weight of an edit followed by a path."""
        if rest is None:
            return None
        low = rest & self.mask
        return rest - low + (cost << self.shift) + self.first[letter] + (low >> _BITS)

    def joined(self, cost: int, audit: str, rest: int | None) -> int | None:
        """The weight of a path followed by another."""
        if rest is None:
            return None
        low = rest & self.mask
        mine = int(audit.translate(_DIGITS) or "0", 8) << (self.shift - _BITS * len(audit))
        return rest - low + (cost << self.shift) + mine + (low >> _BITS * len(audit))

    def read(self, weight: int) -> tuple[int, str]:
        return weight >> self.shift, f"{weight & self.mask:0{self.width}o}".rstrip("0").translate(_LETTERS)


def least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def _with_inserts(w: Weights, best: list) -> list:
    """The least weights where up to two rows may be inserted first; more would come back to the same role."""
    once = [w.before("I", INSERT, best[FOLLOWS[s]]) for s in STATES]
    return [least(best[s], once[s], w.before("I", INSERT, once[FOLLOWS[s]])) for s in STATES]


def least_weights(w: Weights, rows: list[tuple[str, str]], after: list) -> list:
    """From each state before rows (initial, fault) the least weight of a repair that goes on with ``after``."""
    best = _with_inserts(w, after)
    for initial, fault in reversed(rows):
        now = []
        for state in STATES:
            options = [w.before("D", DELETE, best[state])]
            if fault not in ("blank", "duplicate"):
                extra, to = UNFINISHED if fault else 0, FOLLOWS[state]
                if initial == INITIALS[to]:
                    options.append(w.before("K", KEEP + extra, best[to]))
                elif state == START and initial == "s":
                    options.append(w.before("K", KEEP + extra, best[SYSTEM]))
                options.append(w.before("R", REROLE + extra, best[to]))
            now.append(least(*options))
        best = _with_inserts(w, now)
    return best


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows (initial, fault)."""
    w = Weights(3 * len(rows) + 4)
    weight = least_weights(w, rows, [0, None, None, 0])[START]
    return w.read(weight)


def between_states(rows: list[tuple[str, str]]) -> list[tuple[int, str] | None]:
    """Cost and audit of the cheapest repair for each state before and each state after, in rows of the former."""
    w = Weights(3 * len(rows) + 4)
    ends = [least_weights(w, rows, [0 if s == end else None for s in STATES]) for end in STATES]
    return [None if ends[end][start] is None else w.read(ends[end][start]) for start in STATES for end in STATES]


def repaired_lines(rows: list[tuple[str, str]], audit: str, state: int = START) -> list[str]:
    """The lines ``role:text`` that the edits of an audit leave of rows (role, text)."""
    lines, left = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter == "K" and state == START and role[:1] == "s":
            state = SYSTEM
        else:
            state = FOLLOWS[state]
        lines.append(f"{role if letter == 'K' else ROLES[state]}:{text}")
    return lines


def state_after(audit: str, initials: list[str], state: int) -> int:
    left = iter(initials)
    for letter in audit:
        initial = "" if letter == "I" else next(left)
        if letter != "D":
            state = SYSTEM if letter == "K" and state == START and initial == "s" else FOLLOWS[state]
    return state


def turn_span(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """The least and greatest turn, and how many there are; nulls do not count."""
    known = {t for t in turns if t is not None}
    return min(known, default=None), max(known, default=None), len(known)


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def counted(found: list[str]) -> list[int]:
    return [found.count(f) for f in ("blank", "duplicate", "truncated")]


# --- Spark ---------------------------------------------------------------------------------------------------

_ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_PIECES = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
     ("cost", pa.int64()), ("audit", pa.string()), ("text", pa.string()), ("rows", pa.list_(_ROW))]
)
_PIECES_DDL = (
    "conv_id long, piece long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, text string, "
    "rows array<struct<turn:long,role:string,text:string>>"
)
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _whole(rows: list[tuple]) -> tuple:
    """What there is to say of a conversation of rows (turn, role, text): the summary and its repaired text."""
    said = [(role, text) for _, role, text in rows]
    initials = [role[:1] for role, _ in said]
    found = faults(said, repeats(said))
    low, high, distinct = turn_span([turn for turn, _, _ in rows])
    cost, audit = cheapest(list(zip(initials, found, strict=True)))
    gaps = 0 if low is None else high - low + 1 - distinct
    return gaps, *counted(found), illegal_pairs(initials), cost, audit, "\n".join(repaired_lines(said, audit))


def _pieces(block: int):
    """Conversations that lie within the task, repaired; pieces of those that may go on in the task before or behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        held: list[tuple] = []
        conv, is_cut, number = None, True, 0

        def close(last: bool) -> None:
            nonlocal number
            done = (None,) * 8 if is_cut or last else _whole(held)
            rows = [dict(zip(("turn", "role", "text"), r, strict=True)) for r in held] if is_cut or last else None
            out.append((conv, base + number, *done, rows))
            number += 1

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != conv:
                    close(False)
                    held, is_cut = [], False
                elif len(held) == block:
                    is_cut = True
                    close(False)
                    held = []
                conv = row[0]
                held.append(row[1:])
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)
                    out = []
        if held:
            close(True)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return run


_BLOCKS = (
    "piece long, low long, high long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, "
    "initials string, costs array<long>, audits array<string>"
)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece (piece, rows, first: the places of rows not said before) what joining needs, without texts."""
    for batch in batches:
        out = []
        for piece, rows, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            said = [(r["role"], r["text"]) for r in rows]
            new = set(first or ())
            found = faults(said, [i not in new for i in range(len(rows))])
            initials = [role[:1] for role, _ in said]
            turns = [r["turn"] for r in rows]
            low, high, distinct = turn_span(turns)
            paths = between_states(list(zip(initials, found, strict=True)))
            costs, audits = [None if p is None else p[0] for p in paths], [None if p is None else p[1] for p in paths]
            # One sign a row; a role without any is told from the others.
            letters = "".join(i if i in "sua" and i else "-" for i in initials)
            out.append((piece, low, high, distinct, turns[0], turns[-1], *counted(found), illegal_pairs(initials), letters, costs, audits))
        types = [pa.int64()] * 10 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
        names = [c.split()[0] for c in _BLOCKS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 13, types, strict=True)], names=names)


_JOINED = "piece long, head long, state int, part string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one conversation: the state before each and its part of the audit; the counts at the first."""
    rows = pdf.sort_values("piece").to_dict("records")
    number = lambda x: None if pd.isna(x) else int(x)
    paths = [[None if a is None else (int(c), a) for c, a in zip(r["costs"], r["audits"], strict=True)] for r in rows]
    w = Weights(sum(max(len(p[1]) for p in each if p) for each in paths))
    ahead = [[0, None, None, 0]]
    for each in reversed(paths):
        ahead.append([least(*(w.joined(*each[4 * s + e], ahead[-1][e]) for e in STATES if each[4 * s + e])) for s in STATES])
    ahead.reverse()
    state, parts = START, []
    for i, each in enumerate(paths):
        end = next(e for e in STATES if each[4 * state + e] and w.joined(*each[4 * state + e], ahead[i + 1][e]) == ahead[i][state])
        parts.append((state, each[4 * state + end][1]))
        state = end
    known = [r for r in rows if number(r["low"]) is not None]
    gaps = 0
    if known:
        # A turn that goes on in the next piece is one.
        twice = sum(number(a["last_turn"]) is not None and number(a["last_turn"]) == number(b["first_turn"]) for a, b in zip(rows, rows[1:]))
        gaps = max(number(r["high"]) for r in known) - min(number(r["low"]) for r in known) + 1 - sum(int(r["turns"]) for r in rows) + twice
    illegal = sum(int(r["illegal"]) for r in rows) + sum(a["initials"][-1] + b["initials"][0] not in LEGAL for a, b in zip(rows, rows[1:]))
    total = [gaps, *(sum(int(r[c]) for r in rows) for c in ("blank", "duplicate", "truncated")), illegal, w.read(ahead[0][START])[0]]
    head = int(rows[0]["piece"])
    return pd.DataFrame([(int(r["piece"]), head, s, part, *total) for r, (s, part) in zip(rows, parts, strict=True)], columns=[c.split()[0] for c in _JOINED.split(", ")])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired text of each piece; null if nothing is left of it."""
    for batch in batches:
        lines = [repaired_lines([(r["role"], r["text"]) for r in rows], audit, state) for rows, state, audit in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(["\n".join(x) if x else None for x in lines], pa.string())], names=["head", "piece", "text"])


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of texts that come in pieces (head, piece, text), one conversation after the other."""
    now, state, is_empty = None, hashlib.sha256(), True

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], names=["head", "sha"])

    for batch in batches:
        for head, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if head != now:
                if now is not None:
                    yield out()
                now, state, is_empty = head, hashlib.sha256(), True
            if text is not None:
                state.update(("" if is_empty else "\n").encode() + text.encode())
                is_empty = False
    if now is not None:
        yield out()


def repair_conversations(rows: DataFrame, scratch: Scratch, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(summary, texts) of conversations, from rows (conv_id, turn, role, text, ...).

    ``summary`` has a row per conversation: conv_id, head, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``texts`` has its repaired lines ``role:text`` joined by line feeds: head, piece, is_whole, text. A conversation of
    up to ``block`` rows is mostly one row; the pieces of another, in order of ``piece`` and joined by line feeds
    without the null ones, are its text.

    Rows stand in order of turn (nulls first), those of one turn in order of role, then text. Null roles and texts
    count as one space; an empty role fits nowhere. Rows with a null conv_id are one conversation. No rows give no
    conversations. Other columns are ignored. Equal rows of one turn come to one task, a stream of bounded memory; the
    audit and the least weights of one conversation's pieces are joined in one task, without texts.
    """
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    order = ["conv_id", "turn", "role", "text"]
    dealt = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = scratch.save(dealt.mapInArrow(_pieces(block), _PIECES_DDL), "pieces")
    whole, cut = pieces.where("rows is null"), pieces.where("rows is not null").select("conv_id", "piece", "rows")

    # Where a row of a cut conversation is said first; equal ones are added up in each task.
    said = cut.select("conv_id", "piece", F.posexplode(F.transform("rows", lambda r: F.sha2(F.concat_ws(":", F.length(r["role"]), r["role"], r["text"]), 256))).alias("place", "mark"))
    first = said.groupBy("conv_id", "mark").agg(F.min(F.struct("piece", "place")).alias("at"))
    places = first.groupBy(F.col("at.piece").alias("piece")).agg(F.collect_list("at.place").alias("first"))
    blocks = cut.join(places, "piece", "left").select("piece", "rows", "first").mapInArrow(_blocks, _BLOCKS)
    joined = blocks.join(cut.select("conv_id", "piece"), "piece").groupBy("conv_id").applyInPandas(_joined, _JOINED)
    joined = scratch.save(joined, "joined")

    summed = joined.groupBy("head").agg(*[F.first(c).alias(c) for c in SUMMARY[:-1]], F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "part"))), lambda p: p["part"]), "").alias("audit"))
    summary = whole.select("conv_id", F.col("piece").alias("head"), *SUMMARY).union(
        summed.join(cut.select("conv_id", F.col("piece").alias("head")), "head").select("conv_id", "head", *SUMMARY)
    )
    of_pieces = joined.select("piece", "head", "state", "part").join(cut, "piece").select("head", "piece", "rows", "state", "part").mapInArrow(_texts, "head long, piece long, text string")
    texts = whole.select(F.col("piece").alias("head"), "piece", F.lit(True).alias("is_whole"), "text").union(of_pieces.select("head", "piece", F.lit(False), "text"))
    return summary, texts


def text_digests(texts: DataFrame) -> DataFrame:
    """(head, sha): the SHA-256 of each conversation's repaired text. Pieces are hashed as a sorted stream."""
    whole = texts.where("is_whole").select("head", F.sha2("text", 256).alias("sha"))
    parts = texts.where("not is_whole").select("head", "piece", "text").repartition("head").sortWithinPartitions("head", "piece")
    return whole.union(parts.mapInArrow(_streamed_digests, "head long, sha string"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults put in, by crc32 of ``conv_id:turn`` modulo 20; nulls count as one space.

    0 drops a row, 1 empties its text, 2 takes its stops out, 3 repeats it, 4 makes it the user's.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", name("conv_id"), name("turn")).cast("binary")) % 20
    hit = rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    changed = hit.where("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
    return changed.drop("copy")
