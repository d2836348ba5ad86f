"""Conversations made well-formed by the cheapest edits of their turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed values of the contract: white space, ends of sentences, costs of edits.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
STOPS = ".!?"
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1

# Turns by the initial of their role; all others are one class.
CLASSES = "sua"
OTHER = len(CLASSES)
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)

# A conversation is empty, or an optional s and pairs of u and a: states start, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
KEEPS = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
# The one state that a user or assistant turn leads to, and that turn.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = ("user", "user", "assistant", "user")
ENDS = (0, 3)

# A turn is one of nine symbols: class and whether it is cut off, or one that must go.
SYMBOLS = 2 * (OTHER + 1) + 1
GONE = SYMBOLS - 1
BLOCK = 4
NEVER = 1 << 20


def with_inserts(costs: list[int]) -> list[int]:
    """Costs to go from each state if turns may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return costs


def moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after) of the edits that use up a turn, by letter."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        kind, cut = divmod(symbol, 2)
        if (state, kind) in KEEPS:
            out.append(("K", cut * CUT_OFF, KEEPS[state, kind]))
        out.append(("R", RENAME + cut * CUT_OFF, NEXT[state]))
    return out


class BlockTables:
    """How cost vectors change over every block of ``BLOCK`` symbols.

    A vector holds the cost of the rest of a conversation from each state, less
    its smallest one.  Inserting and renaming bound the differences, so there
    are few vectors, which are found from the one at the end; tables over
    (block, vector on its right) give the vector on its left and what was taken off.
    """

    def __init__(self):
        def stepped(symbol: int, vector: tuple) -> tuple[int, tuple]:
            costs = with_inserts([min(c + vector[q2] for _, c, q2 in moves(symbol, q)) for q in range(4)])
            least = min(costs)
            return least, tuple(c - least for c in costs)

        last = tuple(with_inserts([0 if q in ENDS else NEVER for q in range(4)]))
        self.vectors, steps = [last], {}
        numbers = {last: 0}
        for v, vector in enumerate(self.vectors):
            for symbol in range(SYMBOLS):
                off, after = stepped(symbol, vector)
                if after not in numbers:
                    numbers[after] = len(self.vectors)
                    self.vectors.append(after)
                steps[symbol, v] = off, numbers[after]
        n = len(self.vectors)
        self.off = np.array([[steps[s, v][0] for v in range(n)] for s in range(SYMBOLS)], np.int32)
        self.to = np.array([[steps[s, v][1] for v in range(n)] for s in range(SYMBOLS)], np.int32)
        off, to = np.zeros((1, n), np.int32), np.arange(n, dtype=np.int32)[None, :]
        for _ in range(BLOCK):
            # one more symbol on the left of every block
            off = (off[None] + self.off[np.arange(SYMBOLS)[:, None, None], to[None]]).reshape(-1, n)
            to = self.to[np.arange(SYMBOLS)[:, None, None], to[None]].reshape(-1, n)
        self.block_off, self.block_to = off, to
        self.one_off, self.one_to = self.off.tolist(), self.to.tolist()
        self.traces = {(s, v, q): self.traced(s, v, q) for s in range(SYMBOLS) for v in range(n) for q in range(4)}

    def traced(self, symbol: int, right: int, state: int) -> tuple[str, int]:
        """The least letters from a state over one turn among the cheapest edits, and the state after it."""
        vector = self.vectors[right]
        here = [c + int(self.off[symbol, right]) for c in self.vectors[self.to[symbol, right]]]
        letters = ""
        while True:
            options = [(e, c + vector[q2], q2, False) for e, c, q2 in moves(symbol, state)]
            options.append(("I", INSERT + here[NEXT[state]], NEXT[state], True))
            edit, _, state, more = min(o for o in options if o[1] == here[state])
            letters += edit
            if not more:
                return letters, state

    def cheapest(self, symbols: np.ndarray) -> tuple[int, str]:
        """The least cost and, of the edits that have it, the least in letters."""
        whole = len(symbols) // BLOCK
        tail = symbols[whole * BLOCK :].tolist()
        codes = symbols[: whole * BLOCK].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
        cost, vector, rights = 0, 0, []
        for symbol in reversed(tail):
            cost += self.one_off[symbol][vector]
            vector = self.one_to[symbol][vector]
        # blocks from the right by lookup; only the vectors between blocks are kept
        bounds = np.empty(whole, np.int32)
        for k in range(whole - 1, -1, -1):
            bounds[k] = vector
            cost += int(self.block_off[codes[k], vector])
            vector = int(self.block_to[codes[k], vector])
        cost += self.vectors[vector][START]
        # from the left, block by block: the vectors inside are found again from the right
        letters, state = [], START
        for block, right in [*zip(symbols[: whole * BLOCK].reshape(-1, BLOCK).tolist(), bounds.tolist(), strict=True), (tail, 0)]:
            rights = [right]
            for symbol in reversed(block[1:]):
                rights.append(self.one_to[symbol][rights[-1]])
            for symbol, v in zip(block, reversed(rights), strict=False):
                text, state = self.traces[symbol, v, state]
                letters.append(text)
        while state not in ENDS:
            letters.append("I")
            state = NEXT[state]
        return cost, "".join(letters)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by a checksum of ``conv_id:turn``, and whether a row is dropped.

    Nulls of ids and turns count as one space in the checksum, those of roles
    and texts become one.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("__fault"),
    )
    fault = F.col("__fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    )
    return rows.drop("__copy")


def by_conversation(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows of a conversation in one partition and in order, to be read as a stream."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def turn_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("__text")]


def streams(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """(conv_id, its rows) of a sorted partition, a row at a time."""
    rows = (row for b in batches for row in zip(*[b.column(c).to_pylist() for c in ("conv_id", *columns)], strict=True))
    return groupby(rows, key=itemgetter(0))


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = BlockTables()
    legal = {(0, 1), (1, 2), (2, 1)}
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        types = [pa.int64()] * 7 + [pa.string()]
        names = [x.split()[0] for x in AUDIT.split(", ")]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        out.clear()
        return made

    for conv_id, rows in streams(batches, "turn", "kind", "fault", "dropped"):
        symbols, faults = bytearray(), [0, 0, 0, 0]
        first = last = before = None
        turns = illegal = 0
        for _, turn, kind, fault, dropped in rows:
            if dropped:
                continue
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
            illegal += before is not None and (before, kind) not in legal
            before = kind
            faults[fault] += 1
            symbols.append(GONE if fault in (BLANK, DUPLICATE) else 2 * kind + (fault == TRUNCATED))
        cost, audit = tables.cheapest(np.frombuffer(bytes(symbols), np.uint8).astype(np.int64))
        gaps = last - first + 1 - turns if turns else 0
        out.append((conv_id, gaps, *faults[1:], illegal, cost, audit))
        if len(out) == 4096:
            yield batch()
    if out:
        yield batch()


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps between turns, faults, illegal neighbours, and the cheapest edits.

    ``rows`` has conv_id, turn, role, text and ``dropped``, which marks rows
    that only keep their conversation in the result.  Rows stand by turn (nulls
    first), then role and the text's MD5.  ``audit`` has the initials of Delete,
    Insert, Keep and Rename in order, the least of those with the least cost.

    A row's first fault counts: blank, duplicate, truncated.  Duplicates are
    found by a window over conversation, role and MD5 of the text, so that
    neither many copies nor a long conversation are held in memory; a
    conversation's edits take a byte or so per turn.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    flagged = rows.select(
        "conv_id",
        "turn",
        "role",
        "dropped",
        F.md5(F.col("text").cast("binary")).alias("__text"),
        (bare == "").alias("__blank"),
        (~F.substring(bare, -1, 1).isin(*STOPS)).alias("__cut"),
    )
    copies = Window.partitionBy("conv_id", "role", "__text", "dropped").orderBy(F.col("turn").asc_nulls_first())
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = (
        F.when(F.col("__blank"), BLANK).when(F.row_number().over(copies) > 1, DUPLICATE).when(F.col("__cut"), TRUNCATED).otherwise(NO_FAULT)
    )
    classed = flagged.select("conv_id", "turn", "role", "__text", "dropped", kind.alias("kind"), fault.alias("fault"))
    # of equal rows the one that is no duplicate comes first
    ordered = by_conversation(classed, *turn_order(), F.col("fault") == DUPLICATE).select("conv_id", "turn", "kind", "fault", "dropped")
    return ordered.mapInArrow(audited, AUDIT)


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies a conversation's edits to its rows, which follow them one by one."""
    out: list[tuple] = []
    held = 0

    def batch() -> pa.RecordBatch:
        nonlocal held
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        names = ("conv_id", "place", "edit", "role", "text")
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        out.clear()
        held = 0
        return made

    for conv_id, rows in streams(batches, "audit", "role", "text"):
        audit = next(rows)[1]
        state, place = START, 0
        for edit in audit:
            _, _, role, text = (None, None, None, "") if edit == "I" else next(rows)
            if edit == "D":
                continue
            if edit == "K":
                state = KEEPS[state, CLASSES.index(role[0])]
            else:
                role, state = ROLE[state], NEXT[state]
            out.append((conv_id, place, edit, role, text))
            place += 1
            held += len(text)
            if len(out) == 4096 or held > 1 << 20:
                yield batch()
    if out:
        yield batch()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of each conversation after the edits of ``found`` (see ``audits``).

    (conv_id, place, edit, role, text), in order within each partition; a
    conversation is read as a stream, its edits first.
    """
    kept = rows.filter(~F.col("dropped"))
    turns = kept.select("conv_id", F.lit(1).alias("__side"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("__text"), "text")
    heads = found.select(
        "conv_id", F.lit(0).alias("__side"), *[F.lit(None).cast(t).alias(c) for c, t in turns.dtypes if c not in ("conv_id", "__side")], "audit"
    )
    both = heads.unionByName(turns.withColumn("audit", F.lit(None).cast("string")))
    ordered = by_conversation(both, F.col("__side"), *turn_order()).select("conv_id", "audit", "role", "text")
    return ordered.mapInArrow(edited, "conv_id long, place long, edit string, role string, text string")


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv_id, rows in streams(batches, "place", "role", "text"):
        digest = hashlib.sha256()
        for n, (_, place, role, text) in enumerate(rows):
            if place != n:
                raise ValueError(f"the turns of conversation {conv_id} are not in order")
            digest.update(f"{chr(10) * (n > 0)}{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([conv_id], pa.int64()), pa.array([digest.hexdigest()])], names=["__id", "repaired_sha256"])


def repair_report(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the SHA-256 of each repaired conversation, ``role:text`` joined by newlines."""
    digests = repaired(rows, found).mapInArrow(digested, "__id long, repaired_sha256 string")
    joined = found.join(digests, F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    nothing = hashlib.sha256().hexdigest()
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(nothing)))
