"""SimHash near-dedup against all pairs of a small table."""

import os
import re

import pytest
import xxhash

from retailprep.llm.queries import QUERIES
from retailprep.llm.simhash import simhash_groups, word_lists

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def plain_fingerprint(text, size=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """{row number: row numbers of its group} by comparing all pairs."""
    group = {i: {i} for i in range(len(prints))}
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius and group[i] is not group[j]:
                merged = group[i] | group[j]
                for k in merged:
                    group[k] = merged
    return group


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    group = plain_components(prints)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in group[i] if rows[k][0] is not None]
        out.append((doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(QUERIES["op2_simhash"](spark, SF_DIR)) == expected(rows)


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "ONE"),
    (6, "two words"),
    (None, "one"),
    (None, "lonely words here stand"),
    (7, "É one É"),
    (8, "é one é"),
    (9, "a b c d e f g h i j k l m n o p q r s t"),
    (9, "a b c d e f g h i j k l m n o p q r s t"),
    (10, "a b c d e f g h i j k l m n o p q r s t"),
    (11, "word " * 1000),
]


@pytest.mark.parametrize("tile_rows", [2, 16384])
def test_odd_rows(spark, tile_rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in ODD], "doc_id long, text string, fingerprint string, key int")
    assert as_rows(simhash_groups(df, tile_rows=tile_rows)) == expected(ODD)


def test_hot_tiles(spark):
    """Many close fingerprints, in tiles of several sizes, give the groups of all pairs."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(150):
        words = list(base)
        words[i % 40] = f"other{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    assert len({c for _, _, c in want}) < 140
    for tile_rows in (8, 100, 16384):
        assert as_rows(simhash_groups(df, tile_rows=tile_rows)) == want


def test_wide_prints_link_near_copies(spark):
    base = [f"w{i}" for i in range(300)]
    near = base[:100] + ["changed"] + base[101:]
    far = [f"v{i}" for i in range(300)]
    rows = [(3, " ".join(base)), (5, " ".join(near)), (7, " ".join(far))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.component_id for r in simhash_groups(df, shingle=5, radius=42, words=4).collect()}
    assert out == {3: 3, 5: 3, 7: 7}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(df).count() == 0


def test_words_of_long_texts():
    text = b"Ab cd\t" * 400_000 + b"tail"
    assert [w for words in word_lists(text) for w in words] == text.lower().split()
