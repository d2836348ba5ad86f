"""How op5 sorts and what it finds at once: keys with ties, runs of rows, positions inside fragments, units of a row."""

import random

import numpy as np
import pyarrow as pa
import pytest

import retailprep.llm.substrings as substrings_module
from retailprep.llm.substrings import CoverRanks, cut_out, dense, first_of_each, first_units, order_by, order_of, unequal, unit_runs, windows_gone


@pytest.mark.parametrize("top", [2, 1 << 20, 1 << 62])
def test_orders_are_those_of_all_keys(top):
    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 3000):
        keys = [draw.integers(0, top, n).astype(np.uint64) for _ in range(3)]
        keys[0] = keys[0] >> np.uint64(40) << np.uint64(40) | draw.integers(0, 2, n).astype(np.uint64)
        got, plain = order_of(*keys), np.lexsort(keys[::-1])
        assert sorted(got.tolist()) == list(range(n))
        assert all((key[got] == key[plain]).all() for key in keys)
        assert (order_by(*keys) == plain).all()
        different = sorted(set(zip(*(k.tolist() for k in keys), strict=True)))
        assert dense(keys).tolist() == [1 + different.index(k) for k in zip(*(k.tolist() for k in keys), strict=True)]


def test_one_row_of_the_smallest_place_for_each_key():
    draw = random.Random(4)
    key = np.array([draw.choice((5, 5 + (1 << 40), 9, 1 << 63)) for _ in range(200)], np.uint64)
    place = np.array([draw.randrange(4) for _ in range(200)])
    least, later = first_of_each(key, place)
    smallest = {k: min(p for q, p in zip(key.tolist(), place.tolist(), strict=True) if q == k) for k in key.tolist()}
    assert {int(key[i]): int(place[i]) for i in least} == smallest and len(least) == len(smallest)
    assert sorted(later.tolist()) == [i for i in range(200) if place[i] > smallest[int(key[i])]]


def test_units_of_a_row_do_not_depend_on_its_run(monkeypatch):
    draw = random.Random(5)
    texts = ["".join(draw.choices("ab c", k=draw.randrange(0, 400))).encode() for _ in range(60)]

    def found():
        out = set()
        for data, first, at, row, anchor, low, high, hashes, unit in unit_runs(pa.array(texts), 12):
            begin = [0, *np.cumsum([len(t) for t in texts[first:]]).tolist()]
            for r, a, lo, hi, h, u in zip(*(x.tolist() for x in (row, anchor, low, high, hashes, unit)), strict=True):
                out.add((first + r, a - begin[r] + at, lo - begin[r] + at, hi - begin[r] + at, h, u))
                assert data[lo : hi + 12].tobytes() == texts[first + r][lo - begin[r] : hi - begin[r] + 12]
        return out

    one = found()
    assert {(r, w) for r, _, lo, hi, _, _ in one for w in range(lo, hi + 1)} == {(r, w) for r, t in enumerate(texts) for w in range(len(t) - 11)}
    monkeypatch.setattr(substrings_module, "RUN_BYTES", 100)
    assert found() == one


def test_positions_outside_fragments_are_not_ranked():
    text = np.frombuffer(b"abracadabra" * 20 + bytes(80), np.uint8)
    within = np.arange(len(text)) < 220
    some, every = CoverRanks(text, 50, within=within), CoverRanks(text, 50)
    assert not some.rank[220:].any() and every.rank[220:].any()
    at = np.flatnonzero(every.rank[:150])
    assert (np.argsort(some.rank[at], kind="stable") == np.argsort(every.rank[at], kind="stable")).all()


@pytest.mark.parametrize("least", [1, 7, 8, 9, 50])
def test_unequal_windows(least):
    draw = random.Random(least)
    text = np.frombuffer(bytes(draw.choices(b"ab", weights=(1, 30), k=500)), np.uint8)
    starts = np.array([draw.randrange(400) for _ in range(300)])
    raw = text.tobytes()
    windows = [raw[s : s + least] for s in starts.tolist()]
    assert unequal(text, starts, least).tolist() == [a != b for a, b in zip(windows[1:], windows, strict=False)]


def test_units_are_found_by_row_and_name():
    row, unit = np.array([0, 0, 0, 2, 2]), np.array([7, 8, 7, 8, 9], np.uint64)
    x, found = first_units(row, unit, np.array([0, 0, 1, 2, 2]), np.array([7, 9, 7, 9, 8], np.uint64))
    assert x.tolist() == [0, 4, 3] and found.tolist() == [0, 3, 4]
    low, high = np.array([0, 3, 5, 20, 23]), np.array([2, 4, 6, 22, 24])
    of, names, masks = np.array([0, 0, 2, 2]), np.array([7, 7, 8, 5], np.uint64), np.array([1, 2, -1, -1])
    assert windows_gone(row, unit, low, high, of, names, masks).tolist() == [0, 1, 5, 6, 20, 21, 22]


@pytest.mark.parametrize("sent", [1, 16 << 20])
def test_spans_end_with_their_row(monkeypatch, sent):
    """Rows that go to their ends, stand beside each other, are empty or have nothing gone; and characters of several bytes."""
    monkeypatch.setattr(substrings_module, "RUN_BYTES", 60)
    monkeypatch.setattr(substrings_module, "SENT_BYTES", sent)
    texts = [b"a" * 30, "xé".encode() * 9, b"", b"b" * 12, "céàüöäñçßøåæ".encode()]
    units = [[u for _, first, _, row, _, _, _, _, unit in unit_runs(pa.array(texts), 12) for r, u in zip(row, unit.view(np.int64).tolist(), strict=True) if first + r == i] for i in range(5)]
    masks = [[-1] * len(u) for u in units]
    units[1], masks[1] = None, None
    masks[4] = [1 if k == 0 else 0 for k in range(len(units[4]))]
    columns = [pa.array(range(5)), pa.array(texts), pa.array(units, pa.list_(pa.int64())), pa.array(masks, pa.list_(pa.int64()))]
    batch = pa.RecordBatch.from_arrays(columns, names=["row_id", "data", "units", "masks"])
    got = pa.Table.from_batches(list(cut_out(12, False)(iter([batch])))).to_pydict()
    assert got["row_id"] == list(range(5))
    gone = [[{"begin": 0, "end": 30}], [], [], [{"begin": 0, "end": 12}], [{"begin": 0, "end": 12}]]
    assert got["spans"] == gone and got["kept"] == [b"", texts[1], b"", b"", texts[4][12:]]
    got = pa.Table.from_batches(list(cut_out(12, True)(iter([batch])))).to_pydict()
    assert got["spans"][4] == [{"begin": 0, "end": 11}] and got["kept"][4].decode() == "ñçßøåæ"
