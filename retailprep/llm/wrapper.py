"""Wrappers of web sites: regular expressions without unions over the block tags of pages.

The children of every box of a page are a list of parts.  What follows itself
becomes a repeated group; lists of two pages are aligned part by part, where
what only one of them has becomes optional, texts become slots, and boxes of
the same label are aligned in turn.  A label that stands in one list more than
``MANY`` times opens a repeated group from its first to its last place, so a
list has at most ``MANY`` times as many parts as there are labels in its box,
however many pages it comes from.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

MANY = 3


@dataclass
class Body:
    """Parts in order, and the ranges of them (first, last) that repeat as a group."""

    parts: list[Part] = field(default_factory=list)
    loops: list[tuple[int, int]] = field(default_factory=list)


@dataclass
class Part:
    """A text of a tag, or a box of a label with its body."""

    label: str
    body: Body | None = None
    repeats: bool = False
    optional: bool = False

    @property
    def key(self) -> tuple[str, bool]:
        return self.label, self.body is None


def bits(places: list[int], size: int) -> int:
    """An integer of ``size`` bits with those at ``places`` set."""
    if len(places) <= 8:
        return sum(1 << k for k in places)
    flags = np.zeros(size, bool)
    flags[places] = True
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def common(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``, in space of some rows.

    A row is one integer with a bit per place of ``b``, 0 where the length grows,
    so a value of ``a`` takes a few operations on whole integers.  The places of
    a value are kept as an integer if they are more than one in 64 of all.
    """
    places: dict[int, list[int]] = {x: [] for x in a}
    kept = [k for k, x in enumerate(b) if x in places]
    for at, k in enumerate(kept):
        places[b[k]].append(at)
    size = len(kept)
    frequent = {x: bits(at, size) for x, at in places.items() if len(at) * 64 > size}
    row = whole = (1 << size) - 1
    for x in a:
        hit = frequent[x] if x in frequent else bits(places[x], size)
        if hit:
            hit &= row
            row = ((row + hit) | (row - hit)) & whole
    out = np.zeros(len(b) + 1, np.int32)
    stays = np.unpackbits(np.frombuffer(row.to_bytes(size // 8 + 1, "little"), np.uint8), count=size, bitorder="little")
    out[1:][kept] = 1 - stays
    return np.cumsum(out, dtype=np.int32)


def matched(left: list, right: list) -> list[tuple[int, int]]:
    """The longest common subsequence of two lists, as pairs of places.

    Equal ends first, then by halves, in linear space, however long the lists are.
    """
    names: dict = {}
    a, b = (np.array([names.setdefault(x, len(names)) for x in side], np.int64) for side in (left, right))
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            out.append((k, m))
        if i == k or j == m:
            continue
        if k - i == 1:
            at = np.flatnonzero(b[j:m] == a[i])
            if len(at):
                out.append((i, j + int(at[0])))
            continue
        half = (i + k) // 2
        before, after, other = a[i:half].tolist(), a[half:k][::-1].tolist(), b[j:m].tolist()
        cut = j + int(np.argmax(common(before, other) + common(after, other[::-1])[::-1]))
        todo += [(i, half, j, cut), (half, k, cut, m)]
    return sorted(out)


def joined(a: Part, b: Part) -> Part:
    """Two parts of one key as one."""
    body = merged(a.body, b.body) if a.body is not None else None
    return Part(a.label, body, a.repeats or b.repeats, a.optional or b.optional)


def merged(a: Body, b: Body) -> Body:
    """The wrapper of all that either of two wrappers describes."""
    if a == b:
        return a
    parts: list[Part] = []
    to_a, to_b = [], []
    i = j = 0
    pairs = matched([p.key for p in a.parts], [p.key for p in b.parts])
    for x, y in [*pairs, (len(a.parts), len(b.parts))]:
        for only, start, end, to in ((a.parts, i, x, to_a), (b.parts, j, y, to_b)):
            for part in only[start:end]:
                to.append(len(parts))
                parts.append(Part(part.label, part.body, part.repeats, True))
        if x < len(a.parts):
            to_a.append(len(parts))
            to_b.append(len(parts))
            parts.append(joined(a.parts[x], b.parts[y]))
        i, j = x + 1, y + 1
    loops = [(to[s], to[e]) for body, to in ((a, to_a), (b, to_b)) for s, e in body.loops]
    return folded(parts, loops)


def collapsed(parts: list[Part], loops: list[tuple[int, int]], segments: list[tuple[int, int]]) -> tuple[list[Part], list[tuple[int, int]]]:
    """Align neighbouring ``segments`` (start, end) with each other and put one repeated group in their place."""
    cells: list[list[int]] = []
    for start, end in segments:
        pairs = matched([parts[c[0]].key for c in cells], [p.key for p in parts[start:end]])
        out, i, j = [], 0, start
        for x, y in [*pairs, (len(cells), end - start)]:
            out += cells[i:x]
            out += [[k] for k in range(j, start + y)]
            if x < len(cells):
                out.append([*cells[x], start + y])
            i, j = x + 1, start + y + 1
        cells = out
    first, last = segments[0][0], segments[-1][1]
    to = list(range(first))
    to += [0] * (last - first)
    group = []
    for at, cell in enumerate(cells):
        whole = parts[cell[0]]
        for k in cell[1:]:
            whole = joined(whole, parts[k])
        group.append(Part(whole.label, whole.body, whole.repeats, whole.optional or len(cell) < len(segments)))
        for k in cell:
            to[k] = first + at
    to += range(first + len(cells), first + len(cells) + len(parts) - last)
    spans = [(min(to[s : e + 1]), max(to[s : e + 1])) for s, e in loops] + [(first, first + len(cells) - 1)]
    return parts[:first] + group + parts[last:], spans


def nested(parts: list[Part], loops: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Groups that cross as one; a group of one part is that part, repeated."""
    out = set(loops)
    while True:
        crossing = next(((x, y) for x in sorted(out) for y in out if x[0] < y[0] <= x[1] < y[1]), None)
        if not crossing:
            break
        out -= set(crossing)
        out.add((crossing[0][0], crossing[1][1]))
    for s, e in out:
        if s == e:
            parts[s] = Part(parts[s].label, parts[s].body, True, parts[s].optional)
    return sorted(x for x in out if x[0] < x[1])


def folded(parts: list[Part], loops: Iterable[tuple[int, int]] = ()) -> Body:
    """A body in which neighbours of one label, then labels that come back too often, then parts that follow themselves are groups."""
    runs: list[Part] = []
    to = []
    for part in parts:
        if runs and runs[-1].key == part.key:
            optional = runs[-1].optional and part.optional
            runs[-1] = joined(runs[-1], part)
            runs[-1].repeats, runs[-1].optional = True, optional
        else:
            runs.append(Part(part.label, part.body, part.repeats, part.optional))
        to.append(len(runs) - 1)
    parts, spans = runs, [(to[s], to[e]) for s, e in loops]
    while True:
        places: dict[tuple[str, bool], list[int]] = {}
        for k, part in enumerate(parts):
            places.setdefault(part.key, []).append(k)
        often = next((at for at in places.values() if len(at) > MANY), None)
        if often:
            between = {p.key for p in parts[often[0] : often[-1]]}
            end = often[-1] + 1
            while end < len(parts) and parts[end].key in between:
                end += 1
            segments = list(zip(often, [*often[1:], end], strict=True))
        else:
            keys = [p.key for p in parts]
            squares = (
                (i, j) for at in places.values() for x, i in enumerate(at) for j in at[x + 1 :] if keys[i:j] == keys[j : 2 * j - i]
            )
            i, j = min(squares, key=lambda x: (x[1] - x[0], x), default=(0, 0))
            if i == j:
                break
            segments = [(i, j), (j, 2 * j - i)]
        parts, spans = collapsed(parts, spans, segments)
    return Body(parts, nested(parts, spans))


def expression(body: Body) -> str:
    """The wrapper as text: ``tag #PCDATA`` for slots, ``( )+`` for repeated and ``( )?`` for optional parts."""
    starts = [sum(s == k for s, _ in body.loops) for k in range(len(body.parts))]
    ends = [sum(e == k for _, e in body.loops) for k in range(len(body.parts))]
    out = []
    for k, part in enumerate(body.parts):
        text = f"{part.label} #PCDATA" if part.body is None else " ".join(x for x in (f"<{part.label}", expression(part.body), f">{part.label}") if x)
        text = f"({text}){'+' if part.repeats else ''}{'?' if part.optional else ''}" if part.repeats or part.optional else text
        out.append("(" * starts[k] + text + ")+" * ends[k])
    return " ".join(out)


def packed(body: Body) -> list:
    """A body as lists for JSON."""
    return [[[p.label, p.repeats, p.optional, None if p.body is None else packed(p.body)] for p in body.parts], body.loops]


def unpacked(lists: list) -> Body:
    parts, loops = lists
    return Body(
        [Part(label, None if inner is None else unpacked(inner), repeats, optional) for label, repeats, optional, inner in parts],
        [(s, e) for s, e in loops],
    )


def to_json(body: Body) -> str:
    return json.dumps(packed(body), ensure_ascii=False, separators=(",", ":"))


def from_json(text: str) -> Body:
    return unpacked(json.loads(text))


class Places:
    """The parts of a wrapper by number, and the walk of a page through them."""

    def __init__(self, wrapper: Body):
        self.labels: list[str] = []
        self.parents: list[int] = []
        self.box: list[bool] = []
        self.bodies: dict[int, tuple[Body, dict[tuple[str, bool], list[int]], list[int]]] = {}
        self._number(wrapper, -1)

    def _number(self, body: Body, parent: int) -> None:
        numbers, places = [], {}
        for k, part in enumerate(body.parts):
            numbers.append(len(self.labels))
            places.setdefault(part.key, []).append(k)
            self.labels.append(part.label)
            self.parents.append(parent)
            self.box.append(part.body is not None)
            if part.body is not None:
                self._number(part.body, numbers[-1])
        self.bodies[parent] = body, places, numbers

    def walk(self, parent: int, keys: list[tuple[str, bool]]) -> list[int]:
        """The part of each child of the box at ``parent``, in order; -1 where the wrapper has none.

        The next part of its label, in the group the walk is in if that has one;
        a group is entered again from its start.
        """
        if parent not in self.bodies:
            return [-1] * len(keys)
        body, places, numbers = self.bodies[parent]
        out, at = [], 0
        for key in keys:
            found = places.get(key)
            if not found:
                out.append(-1)
                continue
            if len(found) > 1:
                inner = [x for x in body.loops if x[0] <= at <= x[1]]
                for s, e in sorted(inner, key=lambda x: x[1] - x[0]):
                    own = [k for k in found if s <= k <= e]
                    if own:
                        found = own
                        break
            at = next((k for k in found if k >= at), found[-1])
            out.append(numbers[at])
        return out
