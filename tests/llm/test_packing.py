"""Packing: every document is placed whole and once, bins hold what they say, and cost little."""

import os
from collections import defaultdict
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailprep.llm.packing import CAPACITIES, best_bins, cost, packed
from retailprep.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def check(rows, wanted, capacities):
    """``wanted``: sorted (doc_id, length) of all documents, if ids are distinct."""
    documents, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r.doc_id].append((r.piece, r.start, r.length))
        bins[r.bin_id].append((r.offset, r.length, r.capacity))
    got = []
    for doc_id, pieces in documents.items():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(pieces)):
            assert (piece, start) == (k, at)
            at += length
        got.append((doc_id, at))
    assert sorted(got) == wanted
    for items in bins.values():
        at = 0
        for offset, length, capacity in sorted(items):
            assert offset == at
            at += length
        assert {c for _, _, c in items} == {min(c for c in capacities if c >= at)}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    wanted = sorted((r.doc_id, len((r.text or "").encode()) + 1) for r in docs.select("doc_id", "text").collect())
    rows = QUERIES["op10_packing"](spark, SF_DIR).collect()
    check(rows, wanted, CAPACITIES)
    room = sum({r.bin_id: r.capacity for r in rows}.values())
    assert sum(r.length for r in rows) >= 0.95 * room


def test_odd_rows_in_shards(spark):
    lengths = [None, -3, 0, 1, 9, 10, 11, 20, 21, 25, 5, 5, 5, 5]
    df = spark.createDataFrame([(i, n, 1, 1) for i, n in enumerate(lengths)], "doc_id long, n int, shard int, bin_id int")
    wanted = [(i, max(n or 0, 0)) for i, n in enumerate(lengths)]
    for shard_pieces in (3, 1000):
        check(packed(df, F.col("n"), (4, 10), shard_pieces=shard_pieces).collect(), wanted, (4, 10))


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, 3)] * 4 + [(None, 7)] * 3, "doc_id long, n int")
    rows = packed(df, F.col("n"), (10,)).collect()
    assert sorted((r.doc_id or -1, r.length) for r in rows) == [(-1, 7)] * 3 + [(1, 3)] * 4
    assert len({r.bin_id for r in rows}) == 4  # three of 7 + 3 and one of 3


def test_empty_table(spark):
    assert packed(spark.createDataFrame([], "doc_id long, n int"), F.col("n")).count() == 0


def cheapest(lengths, capacities, overhead, square):
    """The least cost over all ways to deal the items to bins."""
    best = float("inf")
    for of in product(range(len(lengths)), repeat=len(lengths)):
        sums = [sum(n for n, b in zip(lengths, of, strict=True) if b == k) for k in set(of)]
        if max(sums) <= max(capacities):
            best = min(best, sum(cost(min(c for c in capacities if c >= s), overhead, square) for s in sums))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 16), min_size=1, max_size=6))
def test_near_the_cheapest(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, cut = best_bins(lengths, (4, 8, 16), 1.0, 64.0)
    assert sorted(i for items in bins for i in items) == list(range(len(lengths)))
    assert sum(cost(c, 1.0, 64.0) for c in cut) <= 1.6 * cheapest(lengths, (4, 8, 16), 1.0, 64.0)


def test_sizes_are_mixed_and_cut():
    bins, cut = best_bins([8, 8, 3], (4, 8, 16), 1.0, 1e9)
    assert sorted(cut) == [4, 16] and len(bins) == 2
    assert best_bins([9, 7], (4, 8, 16), 1.0, 1e9)[1] == [16]
    # Dear attention makes short sequences pay.
    assert set(best_bins([4] * 8, (4, 8, 16), 0.0, 1.0)[1]) == {4}
