"""Vector near-dedup against the cosines of all pairs."""

import os

import numpy as np
import pytest

from retailprep.llm.queries import QUERIES
from retailprep.llm.vectors import vector_groups

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, label int, node string, key long"


def plain(rows, least=0.98):
    """[(vec_id, n_links, component_id, kept)] by comparing all pairs."""
    good = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and None not in v
        w = np.array(v, np.float32).astype(float) if ok else None
        good.append(w if ok and np.isfinite(w).all() and w.any() else None)
    links = [0] * len(rows)
    group = {i: {i} for i in range(len(rows))}
    for i, a in enumerate(good):
        for j in range(i):
            b = good[j]
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2]:
                continue
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                merged = group[i] | group[j]
                for k in merged:
                    group[k] = merged
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        name = min((rows[k][0] for k in group[i] if rows[k][0] is not None), default=None)
        out.append((vec_id, links[i], name, vec_id is not None and vec_id == name))
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert as_rows(QUERIES["op6_vectors"](spark, SF_DIR)) == plain(rows)


def test_recall_at_the_threshold(spark):
    """Pairs of cosines from 0.98 to 0.99, the hardest ones: nearly all are found, and no others."""
    draw = np.random.default_rng(5)
    rows = []
    for i in range(600):
        v = draw.standard_normal(64)
        side = draw.standard_normal(64)
        side -= v * (side @ v) / (v @ v)
        cosine = draw.uniform(0.97, 0.99)
        twin = v / np.linalg.norm(v) * cosine + side / np.linalg.norm(side) * np.sqrt(1 - cosine**2)
        rows += [(2 * i, v.tolist(), i % 7), (2 * i + 1, twin.tolist(), i % 7)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got, want = as_rows(vector_groups(df)), plain(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.98 * there <= found <= there and there > 400


ODD = [
    (1, [1.0, 0.0], 1),
    (2, [2.0, 0.0], 1),
    (2, [2.0, 0.0], 1),
    (3, [2.0, 0.0], 2),
    (4, None, 1),
    (5, [], 1),
    (6, [0.0, 0.0], 1),
    (7, [1.0, None], 1),
    (8, [float("nan"), 1.0], 1),
    (9, [float("inf"), 1.0], 1),
    (10, [1.0, 0.0], None),
    (11, [1.0, 0.0, 0.0], 1),
    (None, [1.0, 0.0], 1),
    (None, [0.0, -1.0], 1),
    (12, [0.0, -3.0], 1),
    (13, [3e38, 0.0], 1),
    (14, [1e-40, 0.0], 1),
]


@pytest.mark.parametrize("tile_rows", [2, 8192])
def test_odd_rows(spark, tile_rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in ODD], SCHEMA)
    assert as_rows(vector_groups(df, tile_rows=tile_rows)) == plain(ODD)


@pytest.mark.parametrize("tile_rows", [10, 8192])
def test_hot_bucket(spark, tile_rows):
    """A large bunch of close vectors: links are counted once over all tables and tiles."""
    draw = np.random.default_rng(3)
    centre = draw.standard_normal(8)
    rows = [(i, (centre + 0.02 * draw.standard_normal(8)).tolist(), 5) for i in range(200)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    want = plain(rows)
    got = as_rows(vector_groups(df, tables=30, bits=4, tile_rows=tile_rows))
    assert {r[2] for r in got} == {0}
    assert got == want


def test_empty_table(spark):
    assert vector_groups(spark.createDataFrame([], SCHEMA)).count() == 0
