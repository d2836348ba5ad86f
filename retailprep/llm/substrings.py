"""Exact substring dedup: suffixes that may repeat are sorted bucket by bucket with a difference cover.

A window is a string of ``least`` bytes; it is removed where it also starts in
a document with a smaller id.  Equal windows are found in three steps.

1. Every window belongs to the n-gram in it with the least hash, its anchor, so
   equal windows have equal anchors at the same place.  An anchor with its
   windows is a unit.  Anchors and units are matched by hash over all
   documents: a unit that a smaller document also has goes whole, one whose
   anchor occurs nowhere else stays.
2. Of the other units, those at the ends of shared passages, the text is sent
   to the bucket of its anchor, where the suffixes starting at its windows are
   sorted to find equal ones.  Memory holds one block of suffixes at a time;
   ties after the first bytes are settled by the ranks of a difference-cover
   sample of the bucket's suffixes, computed beforehand.
3. An anchor with very many different units is split: each of its windows goes
   to a bucket of its own.

What leaves a task is reduced before it is shuffled: of equal units or
windows met there only the one of the smallest document is sent on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .components import looked_up
from .text import POWERS, SECOND, SLICE_BYTES, THIRD, flat, mixed, parts_of, runs_of_rows

LEAST_BYTES = 50
MOST_WINDOWS = 27
# Anchors held by a task before they are reduced and sent.
HELD = 1 << 20
# Units of one anchor that are sorted together; anchors with more are split.
UNITS_OF_ANCHOR = 4096
# Bytes of whole rows whose units are found together: what is made of them fits a processor's cache.
RUN_BYTES = 1 << 16
# Bytes of fragments sorted together, and suffixes held by one block of them.
BUCKET_BYTES = 1 << 20
# Bytes of text whose units make up a bucket.
TEXT_BYTES = 8 << 20
BLOCK_SUFFIXES = 1 << 18
# Bytes of texts sent on together once they are cut.
SENT_BYTES = 16 << 20
PERIOD = 32
LAST = 2**63 - 1
GONE, CHECK, SPLIT = 0, 1, 2
ALL = -1


def gram_bytes(least: int) -> int:
    return max(1, least - min(MOST_WINDOWS, (least + 1) // 2) + 1)


def units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(row, anchor, low, high, anchor hash, unit hash): high is the last window of the unit.

    ``data`` holds rows back to back; windows lie within a row.
    """
    gram = gram_bytes(least)
    span = least - gram + 1
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    up, down = POWERS.get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:n], out=sums[1:])
    h = mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    low_bits = np.uint64((1 << 22) - 1)
    least_of = (h & ~low_bits) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        least_of = np.minimum(least_of[:-size], least_of[size:])
        size *= 2
    if size < span:
        least_of = np.minimum(least_of[: len(h) - span + 1], least_of[span - size :])
    long = np.flatnonzero(ends - starts >= least)
    if not len(long):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    # Windows begin in these ranges; a unit begins with each of them and where the anchor changes.
    begin, end = starts[long], ends[long] - least + 1
    step = np.zeros(n - least + 2, np.int8)
    step[begin] += 1
    step[end] -= 1
    new = np.cumsum(step[:-1], dtype=np.int8).view(bool)
    new[1:] &= least_of[1:] != least_of[:-1]
    new[begin] = True
    low = np.flatnonzero(new)
    of = np.searchsorted(begin, low, "right") - 1
    high = np.minimum(np.append(low[1:], n), end[of]) - 1
    anchor = (least_of[low] & low_bits).astype(np.int64)
    unit = (sums[high + least] - sums[low]) * down[low]
    unit = mixed(unit + (anchor - low).astype(np.uint64) * SECOND + (high - low).astype(np.uint64) * THIRD)
    return long[of], anchor, low, high, h[anchor], unit


def unit_slices(data: np.ndarray, offsets: np.ndarray, first: int, last: int, least: int) -> Iterator[tuple]:
    """(data, where it begins, units ...) of rows ``first`` to ``last``; a long row comes in several slices."""
    lo, hi = int(offsets[first]), int(offsets[last])
    if hi - lo <= 2 * SLICE_BYTES:
        part = data[lo:hi]
        yield part, 0, *units(part, offsets[first:last] - lo, offsets[first + 1 : last + 1] - lo, least)
        return
    for at in range(lo, hi, SLICE_BYTES):
        part = data[at : min(hi, at + SLICE_BYTES + least - 1)]
        yield part, at - lo, *units(part, np.zeros(1, np.int64), np.array([len(part)]), least)


def unit_runs(column: pa.Array, least: int) -> Iterator[tuple]:
    """(data, first row, units ...) of slices of a binary column; long rows come in several."""
    data, offsets = flat(column)
    for first, last in runs_of_rows(offsets, RUN_BYTES):
        for part, at, *found in unit_slices(data, offsets, first, last, least):
            yield part, first, at, *found


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and where those of each row begin and end; null is empty."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes)))


def order_of(key: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Rows in the order of unsigned keys, the first one first.

    Sorted are the high bits of the first key with the row in their place of the
    low ones, then by all keys those that share the former and are not equal.
    """
    bits = max(1, (len(key) - 1).bit_length())
    low_bits = np.uint64((1 << bits) - 1)
    rough = np.sort((key & ~low_bits) | np.arange(len(key), dtype=np.uint64))
    order = (rough & low_bits).astype(np.int64)
    rough >>= np.uint64(bits)
    same = rough[1:] == rough[:-1]
    tied = np.flatnonzero(same)
    if not len(tied):
        return order
    one, next_one = order[tied], order[tied + 1]
    differ = key[one] != key[next_one]
    for other in more:
        differ |= other[one] != other[next_one]
    if differ.any():
        group = np.cumsum(np.concatenate(([False], ~same)))
        some = np.zeros(int(group[-1]) + 1, bool)
        some[group[tied[differ]]] = True
        some = some[group]
        rows = order[some]
        order[some] = rows[np.lexsort([k[rows] for k in (*more[::-1], key)] + [group[some]])]
    return order


def order_by(*columns: np.ndarray) -> np.ndarray:
    """Rows in the order of columns of numbers from 0 on, equal rows in their own one; sorted as one number if they fit."""
    n = len(columns[0])
    widths = [int(c.max(initial=0)).bit_length() for c in columns]
    bits = max(1, (n - 1).bit_length())
    if sum(widths) + bits > 64:
        return np.lexsort(columns[::-1])
    key = np.zeros(n, np.uint64)
    for column, width in zip(columns, widths, strict=True):
        key = key << np.uint64(width) | column.astype(np.uint64)
    key = key << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64)


def first_of_each(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold the smallest place of their key, one for each key, and rows with a larger one."""
    order = order_of(key)
    key, place = key[order], place[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    group = np.cumsum(new) - 1
    smallest = np.minimum.reduceat(place, np.flatnonzero(new))[group]
    least = np.flatnonzero(place == smallest)
    one = np.concatenate(([True], group[least][1:] != group[least][:-1]))
    return order[least[one]], order[place > smallest]


SENT = "bucket int, done boolean, anchors binary, units binary, places binary"


def sent_units(least: int, buckets: int):
    """Blocks of (anchor, unit, place) for each bucket of anchors, and units known to go."""

    def rows(bucket, done, anchors, unit, place):
        return [bucket, done, anchors.tobytes(), unit.tobytes(), place.tobytes()]

    def flushed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch | None:
        hashes, unit, place = (np.concatenate(x) for x in zip(*held, strict=True))
        keep, gone = first_of_each(unit, place)
        out = []
        # Buckets by high bits of the anchor's hash, which is mixed anew: anchors have the least hashes of their windows,
        # so most of those begin with zeros.  32 bits of the hash itself tell anchors of a bucket apart.
        bucket = ((mixed(hashes) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        short = hashes.astype(np.uint32)
        for done, some in ((False, keep), (True, gone)):
            some = some[np.argsort(bucket[some], kind="stable")]
            cuts = np.searchsorted(bucket[some], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                part = some[cuts[b] : cuts[b + 1]]
                out.append(rows(b, done, short[part] if not done else short[:0], unit[part], place[part]))
        if not out:
            return None
        kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
            names=["bucket", "done", "anchors", "units", "places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in parts_of(batches):
            place = batch.column("place").to_numpy()
            for _, first, _, row, _, _, _, hashes, unit in unit_runs(batch.column("data"), least):
                held.append((hashes, unit, place[first + row]))
                count += len(row)
                if count >= HELD:
                    yield from filter(None, [flushed(held)])
                    held, count = [], 0
        if count:
            yield from filter(None, [flushed(held)])

    return run


def matched(units_of_anchor: int):
    """(place, unit, fate) of the units of each bucket that go, or that must be looked at."""

    def settled(blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        known = [b for b in blocks if b[0]]
        for _, _, unit, place in known:
            yield found(np.frombuffer(place, np.int64), np.frombuffer(unit, np.uint64), GONE)
        rest = [b for b in blocks if not b[0]]
        if not rest:
            return
        anchor = np.concatenate([np.frombuffer(b[1], np.uint32) for b in rest])
        unit = np.concatenate([np.frombuffer(b[2], np.uint64) for b in rest])
        place = np.concatenate([np.frombuffer(b[3], np.int64) for b in rest])
        order = np.lexsort((place, unit, anchor))
        anchor, unit, place = anchor[order], unit[order], place[order]
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new_unit = new_anchor | np.concatenate(([True], unit[1:] != unit[:-1]))
        smallest = place[new_unit][np.cumsum(new_unit) - 1]
        later = place > smallest
        yield found(place[later], unit[later], GONE)
        group = np.cumsum(new_anchor) - 1
        kinds = np.bincount(group[new_unit])[group]
        for fate, some in ((CHECK, (kinds > 1) & (kinds <= units_of_anchor)), (SPLIT, kinds > units_of_anchor)):
            yield found(place[new_unit & some], unit[new_unit & some], fate)

    def found(place: np.ndarray, unit: np.ndarray, fate: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(unit.view(np.int64)), pa.array(np.full(len(place), fate, np.int32))], names=["place", "unit", "fate"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "done", "anchors", "units", "places")), strict=True):
                if row[0] != bucket:
                    yield from settled(held)
                    held, bucket = [], row[0]
                held.append(row[1:])
        yield from settled(held)

    return run


def first_units(row: np.ndarray, unit: np.ndarray, of: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first unit of each row ``of`` with one of ``names``, and which of these there is one for."""
    known, code = np.unique(unit, return_inverse=True)
    own = row * len(known) + code
    order = np.argsort(own, kind="stable")
    own = own[order]
    where = np.minimum(np.searchsorted(known, names), len(known) - 1)
    key = of * len(known) + where
    at = np.minimum(np.searchsorted(own, key), len(own) - 1)
    found = (known[where] == names) & (own[at] == key)
    return order[at[found]], np.flatnonzero(found)


FRAGMENT = "key long, place long, unit long, window int, windows int, lead int, data binary, mask long"


def fragments(least: int):
    """The text of units to look at, keyed by their anchor, and of windows of split ones, keyed by themselves.

    Of equal windows met here the one of the smallest place is sent; the
    others get their verdict, a mask with the bit of the window, at once.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = ["key", "place", "unit", "window", "windows", "lead", "data", "mask"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def checked(key, place, unit, windows, lead, data) -> pa.RecordBatch:
        n = len(data)
        columns = [pa.array(key.view(np.int64)), pa.array(place), pa.array(unit.view(np.int64)), pa.array(np.zeros(n, np.int32))]
        columns += [pa.array(windows.astype(np.int32)), pa.array(lead), pa.array(data, pa.binary()), pa.nulls(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "place", "unit", "window", "windows", "lead", "data", "mask"])

    def reduced(split: list[tuple]) -> list[tuple]:
        split.sort(key=lambda r: (r[6], r[1]))
        out, first = [], None
        for r in split:
            if first is None or r[6] != first[6]:
                first = r
                out.append(r)
            elif r[1] > first[1]:
                out.append((r[0], r[1], r[2], r[3], 0, 0, b"", 1 << r[3]))
            else:
                out.append(r)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: list[tuple] = []
        for batch in parts_of(batches):
            place = batch.column("place").to_numpy()
            (names, cuts), (fates, _) = (lists_of(batch.column(c)) for c in ("units", "fates"))
            names = names.view(np.uint64)
            for data, first, _, row, anchor, low, high, hashes, unit in unit_runs(batch.column("data"), least):
                if not len(row):
                    continue
                raw = data.tobytes()
                wanted = slice(cuts[first], cuts[first + int(row[-1]) + 1])
                of = np.repeat(np.arange(int(row[-1]) + 1), np.diff(cuts[first : first + int(row[-1]) + 2]))
                x, found = first_units(row, unit, of, names[wanted])
                fate = fates[wanted][found]
                some = x[fate == CHECK]
                if len(some):
                    lead = (anchor[some] - low[some]).astype(np.int32)
                    text = [raw[lo:hi] for lo, hi in zip(low[some].tolist(), (high[some] + least).tolist(), strict=True)]
                    yield checked(hashes[some], place[first + row[some]], unit[some], high[some] - low[some] + 1, lead, text)
                for i in x[fate != CHECK].tolist():
                    name, own = int(unit[i].astype(np.int64)), int(place[first + row[i]])
                    for s in range(int(low[i]), int(high[i]) + 1):
                        window = raw[s : s + least]
                        split.append((hash_of(window), own, name, s - int(low[i]), 1, 0, window, None))
                    if len(split) >= HELD // 8:
                        yield batch_of(reduced(split))
                        split = []
        if split:
            yield batch_of(reduced(split))

    return run


def hash_of(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data, 7) - (1 << 63)


def difference_cover(period: int) -> list[int]:
    """Residues such that any two numbers have one shift below ``period`` that takes both to one of them.

    Small steps up to the root of the period, then steps of the root.
    """
    root = int(np.ceil(np.sqrt(period)))
    return sorted({*range(root), *(k * root % period for k in range(1, root + 1)), period - 1})


class CoverRanks:
    """Ranks of the suffixes of ``text`` that start at a difference-cover sample, by their first bytes.

    ``depth`` bytes at least decide; suffixes that agree in them share a rank.
    Ranks come from sorting the first ``period`` bytes and doubling from there:
    a sample position plus the period is one again.  Only positions that are
    ``within`` are ranked, if given; the others come first.
    """

    def __init__(self, text: np.ndarray, depth: int, period: int = PERIOD, within: np.ndarray | None = None):
        self.period = period
        cover = difference_cover(period)
        inside = np.zeros(period, bool)
        inside[cover] = True
        # shift[a, b]: how far both a suffix of residue a and one of residue b are from a sample.
        self.shift = np.zeros((period, period), np.int64)
        for a in range(period):
            for b in range(period):
                self.shift[a, b] = next(d for d in range(period) if inside[(a + d) % period] and inside[(b + d) % period])
        sample = np.flatnonzero(inside[np.arange(len(text) - period) % period]) if len(text) > period else np.zeros(0, np.int64)
        if within is not None:
            sample = sample[within[sample]]
        rank = np.zeros(len(text) + period, np.int64)
        rank[sample] = dense([*words(text, sample, period)])
        reach = period
        while reach < depth:
            after = np.minimum(sample + reach, len(rank) - 1)
            rank[sample] = dense_pairs(rank[sample], rank[after])
            reach *= 2
        self.rank = rank


def words(text: np.ndarray, starts: np.ndarray, size: int) -> list[np.ndarray]:
    """The ``size`` bytes from each start as numbers of eight bytes that sort like them."""
    view = np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))
    return [view[starts + at].astype(np.uint64) for at in range(0, size, 8)]


def dense(keys: list[np.ndarray]) -> np.ndarray:
    """The rank of each row among the different rows, from 1."""
    return ranked(keys, order_of(*keys)) if len(keys[0]) else np.zeros(0, np.int64)


def dense_pairs(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``dense`` of two columns of ranks."""
    return ranked([one, other], order_by(one, other)) if len(one) else np.zeros(0, np.int64)


def ranked(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def sorted_blocks(text: np.ndarray, starts: np.ndarray, ranks: CoverRanks, most: int = BLOCK_SUFFIXES) -> Iterator[np.ndarray]:
    """``starts`` in the order of the suffixes of ``text``, a block of them at a time.

    Blocks are ranges of the first eight bytes; suffixes that share those are
    never parted.  Within a block they are sorted by their first bytes.  Ties
    of one residue are ordered by the rank of the next sample position; ties
    of several residues by comparing one suffix of each rank, at the shift
    where both meet the sample.
    """
    first = words(text, starts, 8)[0]
    edges = np.sort(first)[most::most]
    for block in range(len(edges) + 1):
        inside = np.ones(len(first), bool)
        if block:
            inside &= first >= edges[block - 1]
        if block < len(edges):
            inside &= first < edges[block]
        some = starts[inside]
        if not len(some):
            continue
        name = dense(words(text, some, ranks.period))
        residue = some % ranks.period
        key = ranks.rank[some + np.diagonal(ranks.shift)[residue]]
        order = order_by(name, residue, key)
        some, name, residue, key = some[order], name[order], residue[order], key[order]
        mixed_up = np.flatnonzero((name[1:] == name[:-1]) & (residue[1:] != residue[:-1]))
        for tie in np.unique(name[mixed_up]).tolist():
            a, b = np.searchsorted(name, (tie, tie + 1))
            some[a:b] = merged(some[a:b], residue[a:b], key[a:b], ranks)
        yield some


def merged(some: np.ndarray, residue: np.ndarray, key: np.ndarray, ranks: CoverRanks) -> np.ndarray:
    """Put suffixes of several residues, each sorted by itself, into one order."""
    new = np.concatenate(([True], (residue[1:] != residue[:-1]) | (key[1:] != key[:-1])))
    cuts = np.append(np.flatnonzero(new), len(some))

    def compare(x: int, y: int) -> int:
        i, j = int(some[cuts[x]]), int(some[cuts[y]])
        shift = ranks.shift[i % ranks.period, j % ranks.period]
        return int(ranks.rank[i + shift] - ranks.rank[j + shift])

    order = sorted(range(len(cuts) - 1), key=cmp_to_key(compare))
    return np.concatenate([some[cuts[k] : cuts[k + 1]] for k in order])


def unequal(text: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """Whether each of ``starts`` but the first has other ``least`` bytes than the one before it."""
    if least < 8:
        view = np.lib.stride_tricks.sliding_window_view(text, least)[starts]
        return (view[1:] != view[:-1]).any(axis=1)
    view = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    out = np.zeros(len(starts) - 1, bool)
    for at in (*range(0, least - 7, 8), least - 8):
        part = view[starts + at]
        out |= part[1:] != part[:-1]
    return out


def judged(rows: list[tuple], least: int) -> pa.RecordBatch | None:
    """(place, unit, mask): the windows of each fragment that also start in one of a smaller place."""
    # A fragment starts such that its anchor lies at a multiple of the period: equal windows share a residue.
    lead = np.array([r[5] for r in rows])
    size = np.array([len(r[6]) for r in rows])
    before = -lead % PERIOD
    room = -(-(before + size) // PERIOD) * PERIOD
    base = np.cumsum(room) - room + before
    text = np.zeros(int(room.sum()) + least + PERIOD + 8, np.uint8)
    data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    begin = np.cumsum(size) - size
    text[np.repeat(base - begin, size) + np.arange(len(data))] = data
    count = np.array([r[4] for r in rows])
    of = np.repeat(np.arange(len(rows)), count)
    start = np.repeat(base - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    place = np.array([r[1] for r in rows])[of]
    within = np.zeros(len(text), bool)
    within[np.repeat(base - begin, size) + np.arange(len(data))] = True
    ranks = CoverRanks(text, least, within=within)
    # Fragments follow each other, and so do their windows.
    number = np.zeros(len(text), np.int64)
    number[start] = np.arange(len(start))
    gone = np.zeros(len(start), bool)
    for block in sorted_blocks(text, start, ranks):
        index = number[block]
        new = np.ones(len(block), bool)
        new[1:] = unequal(text, block, least)
        smallest = np.minimum.reduceat(place[index], np.flatnonzero(new))[np.cumsum(new) - 1]
        gone[index] = place[index] > smallest
    if not gone.any():
        return None
    window = np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count) + np.array([r[3] for r in rows])[of]
    mask = np.zeros(len(rows), np.int64)
    np.bitwise_or.at(mask, of[gone], np.int64(1) << window[gone])
    some = np.flatnonzero(mask)
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[i][1] for i in some], pa.int64()), pa.array([rows[i][2] for i in some], pa.int64()), pa.array(mask[some])],
        names=["place", "unit", "mask"],
    )


def sorted_buckets(least: int, bucket_bytes: int):
    """Judge fragments as they come, sorted by key; whole keys together, up to so many bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        names = ["key", "place", "unit", "window", "windows", "lead", "data", "mask"]
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in names), strict=True))
            told = [r for r in rows if r[7] is not None]
            if told:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in told], pa.int64()) for k in (1, 2, 7)], names=["place", "unit", "mask"]
                )
            for r in rows:
                if r[7] is not None:
                    continue
                if size >= bucket_bytes and r[0] != last:
                    yield from filter(None, [judged(held, least)])
                    held, size = [], 0
                held.append(r)
                size += len(r[6])
                last = r[0]
        if held:
            yield from filter(None, [judged(held, least)])

    return run


def whole_characters(raw: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``inside`` without the bytes of UTF-8 characters that are not inside whole; rows begin at ``starts``."""
    first = (raw & 0xC0) != 0x80
    first[starts[starts < len(raw)]] = True
    begins = np.flatnonzero(first)
    if not len(begins):
        return inside
    return np.repeat(np.logical_and.reduceat(inside, begins), np.diff(np.append(begins, len(raw))))


def cut_out(least: int, by_characters: bool):
    """(kept, spans) of each text and the masks of its units."""

    def cut(data: np.ndarray, offsets: np.ndarray, first: int, last: int, names: np.ndarray, masks: np.ndarray, cuts: np.ndarray) -> tuple:
        """(kept bytes, how many of each row, begins and ends of spans, how many of each row) of a run of rows."""
        lo, hi = int(offsets[first]), int(offsets[last])
        raw, starts = data[lo:hi], offsets[first : last + 1] - lo
        wanted = slice(cuts[first], cuts[last])
        if wanted.start == wanted.stop:
            none = np.zeros(0, np.int64)
            return raw, np.diff(starts), none, none, np.zeros(last - first, np.int64)
        of = np.repeat(np.arange(last - first), np.diff(cuts[first : last + 1]))
        change = np.zeros(hi - lo + 1, np.int32)
        for _, shift, row, _, low, high, _, unit in unit_slices(data, offsets, first, last, least):
            begins = windows_gone(row, unit, low, high, of, names[wanted], masks[wanted]) + shift
            # Slices of a row have no windows in common.
            change[begins] += 1
            change[begins + least] -= 1
        gone = np.cumsum(change[:-1]) > 0
        if by_characters:
            gone = whole_characters(raw, gone, starts[:-1])
        edge = np.zeros(hi - lo + 1, bool)
        edge[starts] = True
        begin = gone.copy()
        begin[1:] &= ~gone[:-1] | edge[1:-1]
        end = gone.copy()
        end[:-1] &= ~gone[1:] | edge[1:-1]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        row = np.searchsorted(starts, begin, "right") - 1
        lost = np.bincount(row, weights=end - begin, minlength=last - first).astype(np.int64)
        return raw[~gone], np.diff(starts) - lost, begin - starts[row], end - starts[row], np.bincount(row, minlength=last - first)

    def batch_of(row_id: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        kept, sizes, begins, ends, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        ends_of = np.concatenate(([0], np.cumsum(sizes)))
        data = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends_of.astype(np.int64)), pa.py_buffer(kept)]).cast(pa.binary())
        spans = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (begins, ends)], names=["begin", "end"])
        spans = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), spans)
        return pa.RecordBatch.from_arrays([row_id, data, spans], names=["row_id", "kept", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            data, offsets = flat(batch.column("data"))
            (names, cuts), (masks, _) = (lists_of(batch.column(c)) for c in ("units", "masks"))
            names, found, begun = names.view(np.uint64), [], 0
            for first, last in runs_of_rows(offsets, RUN_BYTES):
                found.append(cut(data, offsets, first, last, names, masks, cuts))
                if offsets[last] - offsets[begun] >= SENT_BYTES or last == batch.num_rows:
                    yield batch_of(batch.column("row_id").slice(begun, last - begun), found)
                    found, begun = [], last

    return run


def windows_gone(
    row: np.ndarray, unit: np.ndarray, low: np.ndarray, high: np.ndarray, of: np.ndarray, names: np.ndarray, masks: np.ndarray
) -> np.ndarray:
    """Starts of the windows that go, by the masks of units ``names`` of the rows ``of``."""
    if not len(unit):
        return np.zeros(0, np.int64)
    known, code = np.unique(names, return_inverse=True)
    key = of * len(known) + code
    order = np.argsort(key, kind="stable")
    key, mask = key[order], masks[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    key, mask = key[new], np.bitwise_or.reduceat(mask, new)
    where = np.minimum(np.searchsorted(known, unit), len(known) - 1)
    own = row * len(known) + where
    at = np.minimum(np.searchsorted(key, own), len(key) - 1)
    hit = (known[where] == unit) & (key[at] == own)
    low, high, mask = low[hit], high[hit], mask[at[hit]]
    count = high - low + 1
    index = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    gone = (np.repeat(mask, count) >> index) & 1 == 1
    return (np.repeat(low, count) + index)[gone]


def units_by_slot(least: int):
    """(slot, unit) of the units of each text, each once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            slot = batch.column("slot").to_numpy()
            for _, first, _, row, _, _, _, _, unit in unit_runs(batch.column("data"), least):
                pairs = np.unique(np.stack((slot[first + row], unit.view(np.int64))), axis=1)
                if pairs.size:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["slot", "unit"])

    return run


def by_row(found: DataFrame, slots: DataFrame, value: str) -> DataFrame:
    """(row, met): the units found at each place, and what was found of them; ``row`` is (place, slot).

    Rows without an id share one place.  What was found there is dealt to them
    by their own units, so that no list holds more than the units of one text;
    the slot is a hash of the text, as equal texts have equal units.
    """
    of_ids = found.where(F.col("place") != LAST).withColumn("slot", F.lit(0).cast("long"))
    at_last = found.where(F.col("place") == LAST).groupBy("unit").agg(F.collect_set(value).alias(value))
    of_others = looked_up(slots, at_last, "unit").select(F.lit(LAST).alias("place"), "unit", F.explode(value).alias(value), "slot")
    both = of_ids.select("place", "slot", "unit", value).union(of_others.select("place", "slot", "unit", value))
    return both.groupBy(F.struct("place", "slot").alias("row")).agg(F.collect_list(F.struct("unit", value)).alias("met"))


def bucket_count(texts: DataFrame) -> int:
    """Buckets for units, by the bytes of the texts: their number grows with the input, what a task holds does not."""
    held = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    return max(2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), held // TEXT_BYTES)


def without_repeats(
    documents: DataFrame,
    least: int = LEAST_BYTES,
    units_of_anchor: int = UNITS_OF_ANCHOR,
    bucket_bytes: int = BUCKET_BYTES,
    by_characters: bool = False,
    kept: str = "kept",
    spans: str = "spans",
) -> DataFrame:
    """``documents`` with ``kept`` (binary) and ``spans`` (begin, end of removed bytes) in place of ``text``.

    Removes every byte covered by a string of ``least`` bytes that also starts
    in a document with a smaller doc_id; overlaps count, and strings are judged
    on the input.  Texts are UTF-8 bytes, null and empty ones have none; no
    match crosses documents, and shorter texts stay whole.  Equal ids, and two
    null ones, are not smaller than each other, so repeated rows do not remove
    each other; a null id comes after all others.  Very long texts are worked
    on in slices.  ``by_characters`` leaves UTF-8 characters that are not
    removed whole.  An empty table gives no rows.  Other columns stay; the text
    of a document is shuffled once.
    """
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place")
    texts = documents.select(place, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    buckets = bucket_count(texts)
    sent = texts.mapInArrow(sent_units(least, buckets), SENT)
    known = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    known = settle(known.mapInArrow(matched(units_of_anchor), "place long, unit long, fate int"))

    # Both joins with the texts shuffle the same rows alike, so Spark does it once.
    rest = [c for c in documents.columns if c not in ("text", kept, spans)]
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data")
    slot = F.when(place == LAST, F.xxhash64(data)).otherwise(F.lit(0).cast("long")).alias("slot")
    rows = documents.select(F.struct(place, slot).alias("row"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row_id"), data)
    others = documents.where(F.col("doc_id").isNull() | (F.col("doc_id").cast("long") == LAST)).select(slot, data)
    slots = settle(others.mapInArrow(units_by_slot(least), "slot long, unit long").distinct())
    check = by_row(known.where(F.col("fate") != GONE), slots, "fate")
    look = looked_up(rows, check.hint("shuffle_hash"), "row")
    look = look.select(F.col("row.place").alias("place"), "row_id", "data", F.col("met.unit").alias("units"), F.col("met.fate").alias("fates"))
    sorted_keys = look.mapInArrow(fragments(least), FRAGMENT).repartition(buckets, "key").sortWithinPartitions("key")
    verdicts = sorted_keys.mapInArrow(sorted_buckets(least, bucket_bytes), "place long, unit long, mask long")
    gone = known.where(F.col("fate") == GONE).select("place", "unit", F.lit(ALL).cast("long").alias("mask")).union(verdicts)
    whole = looked_up(rows, by_row(gone, slots, "mask").hint("shuffle_hash"), "row", "left")
    whole = whole.select("row_id", "data", F.col("met.unit").alias("units"), F.col("met.mask").alias("masks"))
    schema = whole.select("row_id", F.lit(b"").alias("kept"), F.expr("CAST(array() AS array<struct<begin:bigint,end:bigint>>)").alias("spans")).schema
    return whole.mapInArrow(cut_out(least, by_characters), schema).select("row_id.*", F.col("kept").alias(kept), F.col("spans").alias(spans))


def texts_without_repeats(documents: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``documents`` with what ``without_repeats`` leaves as ``text``, by whole characters; a null text becomes empty."""
    found = without_repeats(documents, least, by_characters=True, kept="__kept", spans="__spans")
    return found.withColumn("text", F.col("__kept").cast("string")).select(*documents.columns)
