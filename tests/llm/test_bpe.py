"""BPE encoding against tiktoken, and the round trip."""

import hashlib
import os

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from retailprep.llm.bpe import Encoder, decoded, encoded, read_ranks
from retailprep.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(path):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


def test_whole_table(spark):
    there = library(PATH)
    want = []
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        ids = there.encode_ordinary(r.text or "")
        joined = " ".join(map(str, ids)).encode()
        want.append((r.doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op7_bpe"](spark, SF_DIR).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("path", [PATH, MULTI])
def test_pieces_like_the_library(path):
    own, there = Encoder(read_ranks(path)), library(path)

    @settings(max_examples=600, deadline=None)
    @given(st.one_of(st.binary(min_size=1, max_size=40), st.text(alphabet="abent sèßs'", min_size=1, max_size=60).map(str.encode)))
    def check(piece):
        assert own.encode(piece) == there._core_bpe.encode_single_piece(piece)

    check()
    for piece in (b"a" * 1000, b"ab" * 500, b" " * 999, b"the" * 300, bytes(range(256)) * 4, b"=" * 77, "ñ".encode() * 101):
        assert own.encode(piece) == there._core_bpe.encode_single_piece(piece)


ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "<|endoftext|> it's we'LL   x\r\n\n  y  "),
    (5, "日本語 🙂🙂 é \u0000 �"),
    (None, "null id"),
    (6, "x" * 50_000 + " " + "ab " * 20_000),
    (6, "x" * 50_000 + " " + "ab " * 20_000),
]


def test_odd_rows_and_round_trip(spark):
    df = spark.createDataFrame([(*r, "old", b"old") for r in ODD], "doc_id long, text string, ids string, data binary")
    out = decoded(encoded(df, PATH, public_tokenizers.PATTERN), PATH)
    assert set(out.columns) == {"doc_id", "ids", "data"}
    there = library(PATH)
    got = sorted(((r.doc_id, r.ids, bytes(r.data)) for r in out.collect()), key=str)
    want = [(i, there.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert decoded(encoded(df, PATH, public_tokenizers.PATTERN), PATH).count() == 0
