"""Cheapest repairs against all edits tried one by one, and rows with odd values."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter
from functools import cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from retailprep.llm.queries import QUERIES
from retailprep.llm.repair import BLOCK, GONE, SYMBOLS, BlockTables, audits, damaged, repair_report, repaired

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
sys.setrecursionlimit(100_000)
GOOD = re.compile("(s?(ua)+)?")


def plain(initials, faults):
    """(cost, audit) by trying every edit at every turn."""

    @cache
    def rest(i, state):
        # what has been written matters only up to its last initial
        options = []
        if i == len(initials) and state in ("", "a"):
            options.append((0, ""))
        step = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if i < len(initials):
            options.append((3, "D", i + 1, state))
            if faults[i] in (None, "truncated"):
                cut = int(faults[i] == "truncated")
                if initials[i] in step and initials[i]:
                    options.append((cut, "K", i + 1, initials[i]))
                options.append((2 + cut, "R", i + 1, step[-1]))
        return options, step[-1]

    @cache
    def best(i, state, inserts):
        options, turn = rest(i, state)
        out = [o if len(o) == 2 else add(o[0], o[1], best(o[2], o[3], 0)) for o in options]
        if inserts < 3:
            out.append(add(2, "I", best(i, turn, inserts + 1)))
        return min(out, default=(1 << 30, ""))

    def add(cost, letter, more):
        return more[0] + cost, letter + more[1]

    return best(0, "", 0)


def symbol(initial, fault):
    if fault in ("blank", "duplicate"):
        return GONE
    return 2 * ("sua".index(initial) if initial in tuple("sua") else 3) + (fault == "truncated")


TABLES = BlockTables()
TURN = st.tuples(st.sampled_from(["s", "u", "a", "u", "a", " ", ""]), st.sampled_from([None, None, None, "blank", "duplicate", "truncated"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(TURN, max_size=14))
def test_cheapest_edits(turns):
    initials, faults = [t[0] for t in turns], [t[1] for t in turns]
    symbols = np.array([symbol(*t) for t in turns], np.int64)
    assert TABLES.cheapest(symbols) == plain(tuple(initials), tuple(faults))


def test_tables_hold_every_block():
    assert TABLES.block_to.shape == (SYMBOLS**BLOCK, len(TABLES.vectors))
    assert len(TABLES.vectors) < 200


def test_long_conversation():
    rng = random.Random(1)
    symbols = np.array([rng.randrange(SYMBOLS) for _ in range(100_001)], np.int64)
    cost, audit = TABLES.cheapest(symbols)
    assert len(audit.replace("I", "")) == len(symbols)
    # any place cuts the problem: the whole is no cheaper than a part
    assert cost >= TABLES.cheapest(symbols[:50_000])[0] - 4


def expected(rows):
    """The whole result, row by row."""
    spaces = " \t\n\x0b\x0c\r"
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        kept = out.setdefault(conv, [])
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    found = []
    for conv, kept in out.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in kept:
            bare = text.rstrip(spaces)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        initials = tuple(r[1][:1] for r in kept)
        cost, audit = plain(initials, tuple(faults))
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines, written, at = [], "", 0
        for edit in audit:
            role, text = (None, "") if edit == "I" else kept[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if written.endswith("u") else "user"
            written += role[:1]
            lines.append(f"{role}:{text}")
        assert GOOD.fullmatch(written)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(found, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(QUERIES["op12_repair"](spark, SF_DIR)) == expected(rows)


def odd_rows():
    rng = random.Random(7)
    texts = ["", None, " \t\n", "Yes.", "No", "So? ", "x" * 5000 + "!", "Yes."]
    roles = ["system", "user", "assistant", None, "", "tool", "user", "assistant"]
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(300)]
    return rows + [(100, t, "user", "Same.") for t in range(400)]


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, cost int")
    found = damaged(df)
    assert as_rows(repair_report(found, audits(found))) == expected(rows)
    turns = repaired(found, audits(found))
    edits = Counter("".join(r.audit for r in audits(found).collect()))
    assert Counter(r.edit for r in turns.collect()) == edits - Counter(D=edits["D"])
    assert turns.filter("edit = 'I' AND text != ''").collect() == []


def test_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = damaged(df)
    assert repair_report(found, audits(found)).collect() == []
