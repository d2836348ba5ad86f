"""Formatted conversations read back as they were."""

import hashlib
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retailprep.llm.chat import GrammarError, formatted, read_back, turns, unescaped, written
from retailprep.llm.queries import MARKED, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
HARD = st.lists(st.sampled_from(["\\", "#", "##", "### ", "<", "</turn>", "/turn>", ": ", ":", " ", "\n", "a", "</turn>\n### user: "]), max_size=12)
TEXT = st.one_of(HARD.map("".join), st.text(max_size=30))


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_round_trip(conversation):
    out = [written(role, text) for role, text in conversation]
    assert list(turns("".join(x for x, _, _ in out))) == conversation
    for (piece, begin, end), (_, text) in zip(out, conversation, strict=True):
        assert unescaped(piece[begin:end]) == text


def test_only_what_conflicts_is_escaped():
    assert written("user", "a\\b # c: d < e")[0] == "### user: a\\b # c: d < e</turn>\n"
    assert written("user", "see ### x")[0] == "### user: see \\### x</turn>\n"
    assert written("user", MARKED)[0] == "### user: \\\\\\### Assistant: \\</turn> ok</turn>\n"
    assert written("user", "\\")[0] == "### user: \\\\</turn>\n"


@pytest.mark.parametrize("text", ["x", "### user", "### user: hi", "### user: hi</turn>", "### a: ### b</turn>\n", "### a</turn>: b</turn>\n"])
def test_other_text_is_refused(text):
    with pytest.raises(GrammarError):
        list(turns(text))


def expected(rows):
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    found = []
    for conv, said in out.items():
        whole = "".join(f"{role}\n{text}\n" for role, text in said)
        loss = "".join(text for role, text in said if role == "assistant")
        size = sum(len(written(*turn)[0]) for turn in said)
        found.append((conv, len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
    return sorted(found, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)]
    assert as_rows(QUERIES["op13_chat"](spark, SF_DIR)) == expected(rows)


ODD = [
    (1, 0, "user", None),
    (1, 1, "assistant", ""),
    (1, 1, "assistant", "### "),
    (1, None, "system", "first"),
    (None, 0, "assistant", "a</turn>\n### user: b"),
    (None, 1, None, "c"),
    (2, 0, "a: b", "x" * 100_000 + "\\"),
    (2, 0, "a: b", "x" * 100_000 + "\\"),
    (3, 0, "assistant", "emoji \U0001f600 \u00e9"),
] + [(4, t, "assistant", "again") for t in range(3000)]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "f", -1) for r in ODD], "conv_id long, turn long, role string, text string, Formatted string, loss_end int")
    pieces = formatted(df)
    assert pieces.columns == ["conv_id", "turn", "formatted", "loss_begin", "loss_end"]
    assert pieces.count() == len(ODD)
    assert as_rows(read_back(pieces)) == expected(ODD)


def test_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(formatted(df)).collect() == []
