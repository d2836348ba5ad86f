"""Exact substring dedup against looking every window up in a dictionary."""

import random

import numpy as np
import pytest

from retailprep.llm.substrings import CoverRanks, by_row, difference_cover, sorted_blocks, without_repeats

LAST = 2**63 - 1


def plain(rows, least):
    """[(doc_id, kept bytes, [(begin, end)])]"""
    first = {}
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for place, t in texts:
        for k in range(len(t) - least + 1):
            w = t[k : k + least]
            first[w] = min(first.get(w, place), place)
    out = []
    for (doc_id, _), (place, t) in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - least + 1):
            if first[t[k : k + least]] < place:
                gone[k : k + least] = b"\x01" * least
        edges = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(bytes(gone), np.int8), [0]))))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out.append((doc_id, bytes(b for b, g in zip(t, gone, strict=True) if not g), spans))
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r.doc_id, bytes(r.kept), [(s.begin, s.end) for s in r.spans]) for r in df.collect()), key=str)


def drawn(seed, count=60, alphabet="ab "):
    """Texts of few letters, cut and pasted from each other, and runs of one letter."""
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        parts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 40)))]
        for _ in range(rng.randrange(0, 4)):
            if texts and (t := rng.choice(texts)):
                a = rng.randrange(len(t))
                parts.append(t[a : a + rng.randrange(1, 120)])
            parts.append(rng.choice(["a" * rng.randrange(90), "é" * rng.randrange(9), "xyz" * rng.randrange(20)]))
        texts.append("".join(parts))
    ids = list(range(count))
    rng.shuffle(ids)
    return [(i if i % 11 else i + 1, t) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize(("least", "units_of_anchor", "bucket_bytes"), [(50, 4096, 8 << 20), (50, 2, 8 << 20), (12, 4096, 100), (3, 1, 50), (1, 4096, 8 << 20)])
def test_drawn_texts(spark, least, units_of_anchor, bucket_bytes):
    rows = drawn(least)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, unit string")
    out = without_repeats(df, least, units_of_anchor, bucket_bytes)
    assert out.columns == ["doc_id", "unit", "kept", "spans"]
    assert as_rows(out) == plain(rows, least)


ODD = [
    (1, None),
    (2, ""),
    (3, "x" * 49),
    (4, "x" * 50),
    (4, "x" * 50),
    (5, "x" * 50),
    (6, "x" * 200 + "end"),
    (None, "x" * 60 + "null"),
    (None, "x" * 60 + "null"),
    (None, "only null rows share this passage of text, fifty bytes and more"),
    (None, "only null rows share this passage of text, fifty bytes and more"),
    (7, "日本語" * 30),
    (8, "本語日" * 30),
    (9, "\x00" * 120),
    (10, "\x00" * 70),
    (-1, "a passage that starts in the smallest document and is told again later on"),
    (11, "before " + "a passage that starts in the smallest document and is told again later on" + " after"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, b"k", 1) for r in ODD], "doc_id long, text string, kept binary, mask int")
    assert as_rows(without_repeats(df)) == plain(ODD, 50)


def test_long_texts_in_slices(spark):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdefgh ", k=5 << 20))
    rows = [(1, long), (2, "start " + long[1_000_000:3_200_000] + " end"), (3, long[4_000_000:4_000_060])]
    got = as_rows(without_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[0] == (1, long.encode(), [])
    assert got[1] == (2, b"start  end", [(6, 2_200_006)]) or got[1][2][0][0] in (5, 6)
    assert got[2] == (3, b"", [(0, 60)])


def test_many_contexts_of_one_passage(spark):
    """A passage in all documents: its anchors meet every context, more than are sorted together."""
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh", k=70))
    rows = [(i, "".join(rng.choices("uvwxyz", k=40)) + passage + "".join(rng.choices("uvwxyz", k=40))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = plain(rows, 50)
    for most in (16, 4096):
        assert as_rows(without_repeats(df, units_of_anchor=most)) == want


def test_rows_without_ids(spark):
    """A third of the rows has no id: none is handed more units than its own text has."""
    rows = [(None if i % 3 == 0 else k, t) for i, (k, t) in enumerate(drawn(9, 90))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert as_rows(without_repeats(df)) == plain(rows, 50)
    found = spark.createDataFrame([(LAST, u, 7) for u in range(1000)] + [(3, 1, 7), (3, 2, 7)], "place long, unit long, mask long")
    slots = spark.createDataFrame([(s, u) for s in range(10) for u in range(s * 5, s * 5 + 5)], "slot long, unit long")
    got = {(r.row.place, r.row.slot): sorted(m.unit for m in r.met) for r in by_row(found, slots, "mask").collect()}
    assert got == {(3, 0): [1, 2], **{(LAST, s): list(range(s * 5, s * 5 + 5)) for s in range(10)}}


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_are_shuffled_once(spark):
    df = spark.createDataFrame(drawn(5), "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = without_repeats(df)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("period", [1, 2, 7, 32, 33])
def test_difference_cover(period):
    cover = difference_cover(period)
    for a in range(period):
        for b in range(period):
            assert any((a + d) % period in cover and (b + d) % period in cover for d in range(period))
    assert len(cover) <= 2 * np.ceil(np.sqrt(period)) + 2


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_suffixes_are_sorted(letters):
    draw = np.random.default_rng(letters)
    text = np.concatenate((draw.integers(1, 1 + letters, 3000), draw.integers(1, 1 + letters, 300).repeat(4))).astype(np.uint8)
    padded = np.concatenate((text, np.zeros(200, np.uint8)))
    starts = np.arange(len(text) - 64)
    got = np.concatenate(list(sorted_blocks(padded, starts, CoverRanks(padded, 64), most=500)))
    raw = padded.tobytes()
    words = [raw[s : s + 64] for s in got.tolist()]
    assert sorted(got.tolist()) == starts.tolist()
    assert words == sorted(words)
