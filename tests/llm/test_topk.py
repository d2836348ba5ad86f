"""Exact search against sorting all scores."""

import math

import numpy as np
import pytest

from retailprep.llm.topk import block_best, packed, top_inner_products, unpacked, whole

SCHEMA = "vec_id long, embedding array<double>, label int, row long, score string"


def plain(rows, k, every=20):
    good = [(i, r[0], [math.floor(64 * x) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, query_id, q in good:
        if query_id is None or query_id % every:
            continue
        scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, c)))), vec_id is None, vec_id or 0) for j, vec_id, c in good if j != i]
        out += [(query_id, rank + 1, None if none else vec_id, -s) for rank, (s, none, vec_id) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()), key=str)


ODD = [
    (0, [1.0, 0.5]),
    (0, [1.0, 0.5]),
    (20, [0.0, 0.0]),
    (40, []),
    (1, [1.0, 0.5]),
    (2, [-0.001, 0.001, 7.0]),
    (3, None),
    (60, [1.0, None]),
    (80, [float("nan"), 1.0]),
    (100, [float("inf")]),
    (None, [1.0, 0.5]),
    (-20, [3.0, -2.0]),
    (4, [1e9, 1e9]),
    (120, [1e12, -1e12]),
    (5, [1e300, 0.0]),
]


@pytest.mark.parametrize("k", [1, 3, 50])
@pytest.mark.parametrize("sizes", [(2, 3), (1024, 8192)])
def test_odd_rows(spark, k, sizes):
    rows = ODD[:-1]
    df = spark.createDataFrame([(*r, None, 1, "x") for r in rows], SCHEMA)
    got = as_rows(top_inner_products(df, k, query_rows=sizes[0], candidate_rows=sizes[1]))
    assert got == plain(rows, k)


def test_numbers_past_longs(spark):
    df = spark.createDataFrame([(*r, None, 1, "x") for r in [(0, [1.0]), (1, [1e300]), (2, [-1e300])]], SCHEMA)
    assert as_rows(top_inner_products(df, 2)) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_ties_and_sparse_terms(spark):
    draw = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in draw.integers(-1, 2, 12) * (draw.random(12) < 0.2)]) for i in draw.permutation(400)]
    df = spark.createDataFrame([(*r, None, 1, "x") for r in rows], SCHEMA)
    assert as_rows(top_inner_products(df, 20, query_rows=7, candidate_rows=50)) == plain(rows, 20)


def test_empty_table(spark):
    assert top_inner_products(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_and_numbers():
    assert whole(np.array([[-0.01, 0.5, 1e300]]), 64).tolist() == [[-1, 32, 2**63 - 1]]
    rows = [np.array([1, -128]), np.array([40000, 2, 3]), np.array([], np.int64), np.array([2**62])]
    assert unpacked([packed(r) for r in rows]).tolist() == [[1, -128, 0], [40000, 2, 3], [0, 0, 0], [2**62, 0, 0]]
    best, scores = next(iter(block_best(np.array([[1]]), np.array([[3], [5], [5], [5]]), 1)))
    assert sorted(zip(best.tolist(), scores.tolist(), strict=True)) == [(1, 5), (2, 5)]
