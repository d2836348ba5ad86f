"""Hashed n-grams of Arrow text columns, computed with numpy over whole batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes worked on at a time: arrays of eight bytes a byte stay near 8 MB each.
SLICE_BYTES = 1 << 20

# Odd multipliers for hashing; any will do, but models and keys depend on them.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
SECOND = np.uint64(0xA24BAED4963EE407)
THIRD = np.uint64(0x9FB21C651E98DF25)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread what differs in any bit over all 64."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    out = []
    for base in (BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Powers:
    """Powers of BASE, kept for the longest slice met so far."""

    def __init__(self):
        self.size = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, SLICE_BYTES + 1024)
            self.up, self.down = powers(self.size)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts_of(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that what is made of a batch stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def runs_of_rows(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together, or of one longer row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def grouped(column: pa.Array, features) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, rows, distinct features) of runs of whole rows.

    ``features(data, starts)`` gives the (row, feature) of every n-gram, with
    features below 2**32; it is called on slices, and long rows are put
    together from several.
    """
    data, offsets = flat(column)
    for first, last in runs_of_rows(offsets):
        lo, hi = int(offsets[first]), int(offsets[last])
        if hi - lo <= SLICE_BYTES:
            rows, found = features(data[lo:hi], offsets[first:last] - lo)
            keys = rows.astype(np.uint64) << np.uint64(32) | found
            keys.sort()
            keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
            yield first, last, (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        else:
            parts = np.zeros(0, np.uint64)
            for a, b in slices(data, lo, hi):
                parts = np.unique(np.concatenate((parts, features(data[a:b], np.zeros(1, np.int64))[1])))
            yield first, last, np.zeros(len(parts), np.int64), parts.astype(np.int64)


def slices(data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Slices of a long row that start at a word and repeat the three words before it.

    Every n-gram of up to three words lies in a slice whole; a word is never cut.
    """
    blank = data[lo:hi] <= 0x20
    words = np.flatnonzero(blank[:-1] & ~blank[1:]) + lo + 1
    words = np.concatenate(([lo], words))
    i = 0
    while True:
        j = max(int(np.searchsorted(words, words[i] + SLICE_BYTES, "right")) - 1, i + 4)
        if j >= len(words) or hi - words[i] <= SLICE_BYTES:
            yield int(words[i]), hi
            return
        yield int(words[i]), int(words[j])
        i = j - 3


SPACE, WORD, MARK = 0, 1, 2
KIND = np.full(256, WORD, np.uint8)
KIND[:0x21] = SPACE
for _low, _high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
    KIND[_low:_high] = MARK
UPPER = np.zeros(256, np.int32)
UPPER[0x41:0x5B] = 1
DIGIT = np.zeros(256, np.int32)
DIGIT[0x30:0x3A] = 1


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, shape) of every run of letters or digits and every run of marks."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    kind = KIND[data]
    edge = np.ones(n, bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[starts[starts < n]] = True
    at = np.flatnonzero(edge)
    to = np.append(at[1:], n)
    keep = kind[at] != SPACE
    at, to = at[keep], to[keep]
    up, down = POWERS.get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = mixed((sums[to] - sums[at]) * down[at])
    upper = np.concatenate(([0], np.cumsum(UPPER[data])))
    digit = np.concatenate(([0], np.cumsum(DIGIT[data])))
    uppers, size = upper[to] - upper[at], to - at
    shape = np.where(uppers == 0, 1, np.where((uppers == size) & (size > 1), 3, 2))
    shape = np.where(digit[to] > digit[at], 4, shape)
    shape = np.where(kind[at] == MARK, 5, shape)
    rows = np.searchsorted(starts, at, "right") - 1
    return rows, h, shape.astype(np.uint64)


def word_ngrams(data: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of words, pairs of words, triples of shapes and words said twice in a row."""
    rows, h, shape = tokens(data, starts)
    pair = rows[1:] == rows[:-1]
    triple = pair[1:] & pair[:-1]
    two = h[1:] + h[:-1] * SECOND
    three = shape[2:] + shape[1:-1] * np.uint64(8) + shape[:-2] * np.uint64(64) + THIRD
    again = pair & (h[1:] == h[:-1]) & (shape[1:] < 5)
    thrice = again[1:] & again[:-1]
    next_but_one = triple & (h[2:] == h[:-2]) & (shape[2:] < 5) & (shape[1:-1] == 5)
    said = [(rows[1:], again, BASE), (rows[2:], thrice, SECOND), (rows[2:], next_but_one, THIRD)]
    out_rows = np.concatenate((rows, rows[1:][pair], rows[2:][triple], *[r[ok] for r, ok, _ in said]))
    out = np.concatenate((h, two[pair], three[triple], *[np.full(int(ok.sum()), mark, np.uint64) for _, ok, mark in said]))
    return out_rows, mixed(out) >> np.uint64(64 - bits)


def char_ngrams(data: np.ndarray, starts: np.ndarray, bits: int, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of byte n-grams of lower-cased words, white space as one mark before and after."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint64)
    space = KIND[data] == SPACE
    low[space] = 0x20
    inner = np.cumsum(space)
    up, down = POWERS.get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((low + np.uint64(1)) * up[:n], out=sums[1:])
    row = np.searchsorted(starts, np.arange(n), "right") - 1
    out_rows, out = [], []
    for size in sizes:
        if n < size:
            continue
        last = np.arange(size - 1, n)
        begin = last - (size - 1)
        ok = row[begin] == row[last]
        # White space may stand at the ends of an n-gram but not inside it.
        ok &= (inner[last] - space[last]) == inner[begin]
        begin = begin[ok]
        h = (sums[begin + size] - sums[begin]) * down[begin] + np.uint64(size * int(THIRD) % 2**64)
        out_rows.append(row[begin])
        out.append(mixed(h) >> np.uint64(64 - bits))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)
