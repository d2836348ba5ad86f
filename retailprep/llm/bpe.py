"""Byte-level BPE: exact encoding by backtracking from longest matches, and decoding."""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries of the memos; a full one starts anew.
MEMO = 1 << 20
PIECE_MEMO = 3 << 16
# Longer pieces are not remembered.
PIECE_CHARS = 64
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 and number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Encoder:
    """Encodes pieces of text as the merges of ``ranks``, lowest rank first, would.

    An Aho-Corasick automaton over the tokens' bytes, written as Latin-1,
    tells how far a token can reach from a place.  Tokens are laid from left
    to right, longest first, as long as each is compatible with the one
    before; where none is, the place is given up for good and the last token
    is taken back.  As the encoding of every prefix is unique, no place is
    given up twice, so the work is linear in the length of the piece.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        self.tokens = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        for token, rank in self.tokens.items():
            self.automaton.add_word(token, rank)
        self.automaton.make_automaton()
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of ``token`` joins; none for a single byte."""
        if token not in self.parts:
            self.parts[token] = None
            word = self.bytes[token]
            for at in range(1, len(word)):
                left, right = self.ranks.get(word[:at], NEVER), self.ranks.get(word[at:], NEVER)
                if left < token and right < token and self.meets(left, right, token):
                    self.parts[token] = (left, right)
                    break
        return self.parts[token]

    def edge(self, token: int, side: int) -> list[tuple[int, bytes]]:
        """The tokens at one end of ``token`` as its merges happen, a byte first, itself last; then a mark."""
        key = (token, side)
        if key not in self.edges:
            parts = self.split(token)
            before = [] if parts is None else self.edge(parts[side], side)[:-1]
            self.edges[key] = [*before, (token, self.bytes[token]), (NEVER, b"")]
        return self.edges[key]

    def meets(self, left: int, right: int, limit: int = NEVER) -> bool:
        """True if no merge of a rank below ``limit`` joins the two tokens across their border.

        A merge's rank is above those of what it joins, so merges happen by
        rank; the two tokens at the border grow step by step until they are
        joined, or are the whole tokens.  Of equal merges the left one is first.
        """
        before, after = iter(self.edge(left, 1)), iter(self.edge(right, 0))
        rank_of = self.ranks.get
        (_, x), (_, y) = next(before), next(after)
        (grow_left, more_left), (grow_right, more_right) = next(before), next(after)
        while True:
            joined = rank_of(x + y)
            if joined is not None and joined < limit and joined < grow_left and joined <= grow_right:
                return False
            if grow_left <= grow_right:
                if grow_left == NEVER:
                    return True
                x = more_left
                grow_left, more_left = next(before)
            else:
                y = more_right
                grow_right, more_right = next(after)

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= MEMO:
                self.fits.clear()
            found = self.fits[key] = self.meets(left, right)
        return found

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text = piece.decode("latin-1")
        longest, token_of, fits, reach = self.automaton.longest_prefix, self.tokens.get, self.fits.get, self.longest
        given_up: set[int] = set()
        out: list[int] = []
        sizes: list[int] = []
        at, n, last = 0, len(text), -1
        size = longest(text[:reach])
        while at < n:
            while size:
                end = at + size
                token = token_of(text[at:end])
                if token is not None and end not in given_up:
                    if last < 0:
                        break
                    ok = fits((last, token))
                    if ok or (ok is None and self.compatible(last, token)):
                        break
                size -= 1
            if size:
                out.append(token)
                sizes.append(size)
                at, last = end, token
                size = longest(text[at : at + reach])
            elif out:
                given_up.add(at)
                out.pop()
                last = out[-1] if out else -1
                size = sizes.pop()
                at -= size
                size -= 1
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out


class Memo(dict):
    """Ids of pieces as bytes of four-byte numbers; pieces met since the last but one renewal."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.encoder.encode(piece.encode())).tobytes()
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECE_MEMO:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def kept_encoder(path: str) -> Memo:
    """The memo for a rank file, kept for as long as a Python worker lives.

    Functions come to workers by value with every task, so what shall outlast
    a task has to hang on a module of the worker.
    """
    kept = sys.modules.setdefault("_kept_encoders", ModuleType("_kept_encoders")).__dict__
    if path not in kept:
        kept[path] = Memo(Encoder(read_ranks(path)))
    return kept[path]


def encoded(documents: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``documents`` with ``ids`` (array of int) in place of ``text``.

    Every match of ``pattern`` in the whole text is encoded by itself with the
    rank file at ``path``, which each worker reads; what the pattern leaves out
    is not encoded, and no special tokens are.  A null or empty text has no
    ids.  Other columns, repeated rows and their number stay; a column called
    like ``ids`` is replaced.
    """
    rest = [c for c in documents.columns if c not in (text, ids)]
    whole = documents.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").cast("string").alias(text))
    schema = whole.select(*[F.col(f"`{c}`") for c in rest], F.array().cast("array<int>").alias(ids)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pieces = regex.compile(pattern).findall
        look = kept_encoder(path).__getitem__
        for batch in batches:
            parts, sizes = [], [0]
            for value in batch.column(text):
                raw = b"".join(map(look, pieces(value.as_py() or "")))
                parts.append(raw)
                sizes.append(len(raw) // 4)
            numbers = pa.array(np.frombuffer(b"".join(parts), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), numbers)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], lists], names=[*rest, ids])

    return whole.mapInArrow(run, schema)


def decoded(tokens: DataFrame, path: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """``tokens`` with the bytes ``data`` that its ``ids`` stand for; no ids and null give no bytes.

    A null or unknown id raises.
    """
    rest = [c for c in tokens.columns if c != data]
    kept = tokens.select(*[F.col(f"`{c}`") for c in rest])
    schema = kept.select("*", F.lit(b"").alias(data)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = None
        for batch in batches:
            look = look or {rank: token for token, rank in read_ranks(path).items()}.__getitem__
            lists = batch.column(ids)
            if lists.null_count:
                lists = pa.array([x or [] for x in lists.to_pylist()], lists.type)
            numbers, cuts = lists.values, np.asarray(lists.offsets).tolist()
            texts = [b"".join(map(look, numbers[a:b].to_numpy(zero_copy_only=False).tolist())) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(texts, pa.binary())], names=[*rest, data])

    return kept.mapInArrow(run, schema)
