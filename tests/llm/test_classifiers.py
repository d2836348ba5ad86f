"""Quality and toxicity: held-out accuracy, and odd tables."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailprep.llm import linear, text
from retailprep.llm.quality import good_documents, quality_scores
from retailprep.llm.queries import QUERIES
from retailprep.llm.toxicity import toxicity_scores

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.1"
CASES = [("op1_quality", "quality", 3, 1, quality_scores), ("op4_toxicity", "toxic", 5, 0, toxicity_scores)]


@pytest.mark.parametrize(("name", "target", "folds", "fold", "_"), CASES)
def test_held_out_accuracy(spark, name, target, folds, fold, _):
    scored = QUERIES[name](spark, LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").groupBy("doc_id").agg(F.max(target).alias("y"))
    rows = scored.join(labels, "doc_id").where("held_out").select("y", "predicted").collect()
    for y in (0, 1):
        own = [r.predicted == r.y for r in rows if r.y == y]
        # A tenth of the toxic documents' few telling words is not among the labelled ones here.
        assert len(own) > 20 and np.mean(own) >= (0.8 if target == "toxic" else 0.95)


@pytest.mark.parametrize(("name", "target", "folds", "fold", "_"), CASES)
def test_whole_table(spark, name, target, folds, fold, _):
    rows = QUERIES[name](spark, SF_DIR).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def odd_tables(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choices("alpha beta gamma delta".split(), k=30)) for _ in range(60)]
    bad = [" ".join(w + "### scum" for w in rng.choices("alpha beta gamma".split(), k=30)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    rows += [(None, good[0]), (200, None), (201, ""), (202, " \n "), (203, "long " * 400_000), (7, good[7]), (7, good[7])]
    documents = spark.createDataFrame([(*r, 0.5, "x", 3) for r in rows], "doc_id long, text string, score double, label string, draw int")
    labels = [(i, int(i < 60), int(i >= 60)) for i in range(120)]
    labels += [(7, 1, 0), (8, 0, 1), (None, 0, 1), (9, None, None), (10, 5, -1), (999, 1, 0), (201, 1, 0)]
    return documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


@pytest.mark.parametrize(("name", "target", "folds", "fold", "scores"), CASES)
def test_odd_rows(spark, name, target, folds, fold, scores):
    documents, labels, rows = odd_tables(spark)
    out = scores(documents, labels).collect()
    assert sorted(((r.doc_id, r.held_out) for r in out), key=str) == sorted(
        ((i, i is not None and zlib.crc32(str(i).encode()) % folds == fold) for i, _ in rows), key=str
    )
    by_id = {r.doc_id: r for r in out}
    right = [by_id[i].predicted == (i < 60 if target == "quality" else i >= 60) for i in range(120)]
    assert np.mean(right) >= 0.97
    assert by_id[200].score == by_id[201].score == by_id[202].score
    assert len({r.score for r in out if r.doc_id == 7}) == 1


@pytest.mark.parametrize(("name", "target", "folds", "fold", "scores"), CASES)
def test_without_labels(spark, name, target, folds, fold, scores):
    documents, labels, rows = odd_tables(spark)
    none = scores(documents, labels.where("doc_id = 12345")).collect()
    assert len(none) == len(rows) and {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    one = scores(documents, labels.where(f"{target} = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.9
    assert scores(documents.limit(0), labels).count() == 0


def test_good_documents_stay_whole(spark):
    documents, labels, _ = odd_tables(spark)
    out = good_documents(documents, labels)
    assert out.schema == documents.schema
    wanted = {r.doc_id for r in quality_scores(documents, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in out.collect()} == wanted


def test_dual_coordinate_descent():
    """The fitted weights reach the least loss that plain subgradient steps find."""
    draw = np.random.default_rng(0)
    rows = [np.sort(draw.choice(30, 6, replace=False)) for _ in range(80)]
    labels = np.array([int(r[0] < 4) for r in rows])
    scale = draw.uniform(0.5, 2, 30)
    settings = linear.Settings(cost=1.0, epochs=400)
    weights, bias = linear.fit(rows, labels, scale, settings)
    sign = np.where(labels == 1, 1.0, -1.0)
    cost = np.where(sign > 0, 80 / (2 * labels.sum()), 80 / (2 * (1 - labels).sum()))
    x = np.zeros((80, 31))
    for k, r in enumerate(rows):
        x[k, r] = scale[r] / np.sqrt((scale[r] ** 2).sum())
    x[:, 30] = 1

    def loss(w):
        return 0.5 * w @ w + cost @ np.maximum(0, 1 - sign * (x @ w))

    w = np.zeros(31)
    best = loss(w)
    for step in range(20_000):
        w -= (w - (cost * sign * (sign * (x @ w) < 1)) @ x) / (step + 10)
        best = min(best, loss(w))
    assert loss(np.append(weights, bias)) <= best * 1.01


def test_ngrams_of_slices(monkeypatch):
    """A long text cut into slices has the n-grams of the whole."""
    import pyarrow as pa

    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abAB1#é", k=rng.randrange(1, 9))) for _ in range(5000))
    column = pa.array(["x", long, None, "", long[:999]])
    for features in (lambda d, s: text.word_ngrams(d, s, 18), lambda d, s: text.char_ngrams(d, s, 18, (3, 5))):
        results = []
        for size in (1 << 20, 2000):
            monkeypatch.setattr(text, "SLICE_BYTES", size)
            monkeypatch.setattr(text.runs_of_rows, "__defaults__", (size,))
            found = set()
            for first, _, rows, numbers in text.grouped(column, features):
                found |= set(zip((rows + first).tolist(), numbers.tolist(), strict=True))
            results.append(found)
        assert results[0] == results[1]
