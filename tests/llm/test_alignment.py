"""Alignment of two vocabularies against the libraries and a plain count."""

import hashlib
import os
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailprep.llm.alignment import PIECE_CHARS, ByteLevel, Numbering, Pieces, aligned, columns_of, merged, pieces_of, run_of
from retailprep.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
A_PATH, B_PATH = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def bytes_of_a():
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return {i: bytes(letters[c] for c in token) for token, i in A.get_vocab().items() if set(token) <= set(letters)}


A_BYTES = bytes_of_a()


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def plain(rows, digest=True):
    """Spans of both sides, every pair of them compared near each other, counted in a dictionary."""
    docs, counts = [], Counter()
    for doc, text in rows:
        text = text or ""
        a = A.encode(" " + text, add_special_tokens=False).ids if text else []
        b = B.encode(text) if text else []
        parts_a, parts_b = [A_BYTES.get(i, b"") for i in a], [b_bytes(i) for i in b]
        want = (" " + text).encode()
        if not text or b"".join(parts_a) != want or b"".join(parts_b) != want:
            docs.append((doc, [], [], [], []))
            continue
        spans = []
        for parts in (parts_a, parts_b):
            at, out = 0, []
            for part in parts:
                out.append((at, at + len(part)))
                at += len(part)
            spans.append(out)
        links, low = [], 0
        for i, (x, y) in enumerate(spans[0]):
            while spans[1][low][1] <= x:
                low += 1
            k = low
            while k < len(b) and spans[1][k][0] < y:
                links.append((a[i], b[k]))
                k += 1
        groups, i, k = [], 0, 0
        for cut in sorted({y for _, y in spans[0]} & {y for _, y in spans[1]}):
            sides = [[], []]
            while i < len(a) and spans[0][i][1] <= cut:
                sides[0].append(a[i])
                i += 1
            while k < len(b) and spans[1][k][1] <= cut:
                sides[1].append(b[k])
                k += 1
            groups.append("|".join(",".join(map(str, side)) for side in sides))
        docs.append((doc, a, b, groups, links))
        counts.update(links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc, a, b, groups, links in docs:
        text = ";".join(groups)
        text = hashlib.sha256(text.encode()).hexdigest() if digest and a else text
        n_best = sum(counts[link] == best[link[1]] for link in links)
        out.append((doc, len(a), len(b), len(groups), len(links), n_best, sum(counts[link] for link in links), text))
    return sorted(out, key=str)


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def as_rows(df, key, groups):
    return sorted((tuple(r) for r in df.select(key, *COLUMNS, groups).collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(QUERIES["op11_alignment"](spark, SF_DIR), "doc_id", "groups_sha256") == plain(rows)


ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "  two  spaces \n\n and\ttabs\r\n"),
    (5, "<|endoftext|> is text, <s> too </s> <unk>"),
    (6, "a\u2581b is a mark of the other side"),
    (7, "\U0001f600 \u00e9t\u00e9 \u4e2d\u6587 \u0645\u0631\u062d\u0628\u0627 e\u0301 \ufb01 \u00a0x"),
    (8, "word " * 30_000),
    (9, "x" * 20_000),
    (None, "null ids stay"),
    (None, "null ids stay"),
    (11, "1234567890 !!! ''' don't we'll\x00\x01"),
    (12, "  " * 3000 + "end"),
]


def test_odd_rows(spark):
    rows = [(*r, 5, "x", "y") for r in ODD]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_A int, chunk string, Groups string").repartition(3)
    # several small chunks, classes and tasks
    found = aligned(df, A_PATH, B_PATH, public_tokenizers.PATTERN, radix=3, chunk_bytes=2000, task_bytes=500)
    assert sorted(found.columns) == sorted(["doc_id", "groups", *COLUMNS])
    assert as_rows(found, "doc_id", "groups") == plain(ODD, digest=False)


def test_many_copies(spark):
    rows = [(i, "one and the same text") for i in range(3000)] + [(-1, "another text of the same")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = aligned(df, A_PATH, B_PATH, public_tokenizers.PATTERN, digest=True, chunk_bytes=4000, task_bytes=300)
    assert as_rows(found, "doc_id", "groups") == plain(rows)


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert aligned(df, A_PATH, B_PATH, public_tokenizers.PATTERN).collect() == []
    nulls = df.sparkSession.range(3).select(F.lit(None).cast("string").alias("text"))
    assert [tuple(r) for r in aligned(nulls, A_PATH, B_PATH, public_tokenizers.PATTERN).select(*COLUMNS, "groups").collect()] == [(0,) * 6 + ("",)] * 3


def test_encoders_like_the_libraries(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect() if r.text]
    a, b = ByteLevel(A_PATH, public_tokenizers.PATTERN), Pieces(B_PATH)
    assert a.encode(texts) == [x.ids for x in A.encode_batch(texts, add_special_tokens=False)]
    long = max(texts, key=len) + " and more" * 300
    parts = pieces_of(long)
    assert "".join(parts) == long and len(parts) > len(long) // PIECE_CHARS // 2
    assert [i for x in b.encode([p[1:] if k else p for k, p in enumerate(parts)]) for i in x] == B.encode(long)


def test_runs():
    numbering = Numbering(50, 7, 3)
    pairs = sorted(int(numbering.pair(a, b)) for a in (0, 49, 7) for b in range(7))
    assert len(set(pairs)) == 21
    assert [int(numbering.side(p)) for p in pairs] == [
        b for b in sorted(range(7), key=lambda b: (b % 3, b)) for _ in range(3)
    ]
    import numpy as np

    x, y = np.array([1, 5, 900]), np.array([2, 1, 1 << 40])
    run = run_of(x, y)
    assert [c.tolist() for c in columns_of(run)] == [x.tolist(), y.tolist()]
    other = run_of(np.array([5, 6]), np.array([10, 1]))
    assert list(merged([run, other, run_of(np.array([], int), np.array([], int))])) == [(1, 2), (5, 11), (6, 1), (900, 1 << 40)]
