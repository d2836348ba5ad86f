"""The pipeline: every stage against its plain counterpart, on a table and on odd rows."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_lines import plain_texts
from test_packing import check
from test_substrings import plain as plain_substrings

import corpus_pipeline
from retailprep.llm.packing import CAPACITIES
from retailprep.llm.quality import quality_scores
from retailprep.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
STAGES = dict(corpus_pipeline.STAGES)
LAST = 2**63 - 1


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def without_lines(rows):
    texts = plain_texts([(r[0], r[1]) for r in rows])
    return sorted(((r[0], text, *r[2:-1], None if text is None else len(text)) for r, text in zip(rows, texts, strict=True)), key=str)


def shingles(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def likeness(a, b):
    return len(a & b) / len(a | b)


def check_near_dedup(before, after):
    """What stays is not alike; what goes is like something else."""
    sets = [(r, shingles(r[1])) for r in before]
    kept = set(after)
    assert kept <= set(before) and len(kept) == len(after)
    seen = set()
    for k, (r, s) in enumerate(sets):
        other = [likeness(s, t) for j, (q, t) in enumerate(sets) if j != k and q != r]
        if r in kept:
            assert all(likeness(s, t) < 0.9 for q, t in sets if q in kept and q != r)
        elif r not in seen:
            assert max(other, default=0) >= 0.6 or before.count(r) > 1
        seen.add(r)


def by_characters(rows):
    """Texts without repeated passages; characters stay unless all their bytes go."""
    out = []
    spans = {(i, t): s for (i, t), (_, s) in zip([(r[0], r[1]) for r in rows], plain_spans(rows), strict=True)}
    for doc_id, text, *rest in rows:
        left, at = [], 0
        for c in text or "":
            end = at + len(c.encode())
            if not any(b <= at and end <= e for b, e in spans[(doc_id, text)]):
                left.append(c)
            at = end
        out.append((doc_id, "".join(left), *rest[:-1], len(left)))
    return sorted(out, key=str)


def plain_spans(rows):
    """(kept, spans) in the order of rows, by naming each row."""
    out = []
    for r in rows:
        mine = [x for x in plain_substrings([(q[0], q[1]) for q in rows], 50) if x[0] == r[0]]
        out.append(next((k, s) for _, k, s in mine if len(k) + sum(e - b for b, e in s) == len((r[1] or "").encode()) and fits(r[1], k, s)))
    return out


def fits(text, kept, spans):
    raw, at, left = (text or "").encode(), 0, b""
    for b, e in spans:
        left += raw[at:b]
        at = e
    return left + raw[at:] == kept


def test_stages_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = STAGES["quality"](spark, docs, SF_DIR)
    assert good.schema == docs.schema
    wanted = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    before = rows_of(good)
    assert before == [r for r in rows_of(docs) if r[0] in wanted]
    assert 0.5 * docs.count() < len(before) < docs.count()

    lines = STAGES["line_dedup"](spark, good, SF_DIR)
    assert lines.columns == docs.columns
    after = rows_of(lines)
    assert after == without_lines(before) and after != before

    near = STAGES["near_dedup"](spark, spark.createDataFrame(after, docs.schema), SF_DIR)
    assert near.columns == docs.columns
    left = rows_of(near)
    check_near_dedup(after, left)

    cut = STAGES["substring_dedup"](spark, spark.createDataFrame(left, docs.schema), SF_DIR)
    assert cut.columns == docs.columns
    texts = rows_of(cut)
    assert texts == by_characters(left)

    rows = STAGES["packing"](spark, spark.createDataFrame(texts, docs.schema), SF_DIR).collect()
    check(rows, sorted((r[0], len(r[1].encode()) + 1) for r in texts), CAPACITIES)


def test_run(spark):
    rows = QUERIES["pipeline"](spark, SF_DIR).collect()
    assert rows and len({r.doc_id for r in rows}) < spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


rng = random.Random(8)
STORY = [f"word{rng.randrange(900)}" for _ in range(200)]
PASSAGE = " ".join(f"shared{rng.randrange(900)}" for _ in range(60))
ODD = [
    (1, None),
    (2, ""),
    (None, " \n "),
    (3, " ".join(STORY)),
    (4, " ".join(STORY)),
    (4, " ".join(STORY)),
    (5, " ".join([*STORY[:90], "changed", *STORY[91:]])),
    (6, "one " + PASSAGE + " two é"),
    (7, "three " + PASSAGE + " ñ four " + "long " * 30_000),
    (None, "a text without id"),
    (None, "a text without id"),
    (8, "kept as it is"),
    (8, "another with that id"),
]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, name):
    schema = "doc_id long, text string, lang string, source string, __score double, label int, name string, kept string, n_chars long"
    rows = [(i, t, "en", None, 0.1, 7, "x", "y", len(t or "")) for i, t in ODD]
    df = spark.createDataFrame(rows, schema)
    if name == "quality":
        df = df.drop("__score")
        out = STAGES[name](spark, df, SF_DIR)
        assert out.columns == df.columns
        assert set(rows_of(out)) <= set(rows_of(df))
        return
    out = STAGES[name](spark, df, SF_DIR)
    if name == "packing":
        assert sorted(r.length for r in out.where("doc_id = 4").collect()) == [len(" ".join(STORY)) + 1] * 2
        assert {r.doc_id for r in out.collect()} == {i for i, _ in ODD}
        return
    assert out.columns == df.columns
    got = rows_of(out)
    if name == "line_dedup":
        assert got == without_lines(rows)
    elif name == "near_dedup":
        want = [(1, None), (3, " ".join(STORY)), *ODD[7:10], *ODD[11:]]
        assert [(r[0], r[1]) for r in got] == sorted(want, key=str)
    else:
        assert got == by_characters(rows)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(F.lit(False))
    assert STAGES[name](spark, docs, SF_DIR).count() == 0


def test_sql():
    assert corpus_pipeline.ORACLE_SQL is None
