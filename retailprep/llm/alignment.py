"""Tokens of two vocabularies laid over each other, and how often their ids meet in the corpus."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import settle

# Text and rows of a chunk, whose links are sorted in memory; a longer document is a chunk by itself.
CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 1 << 16
# Longer texts are encoded piece by piece, cut where neither vocabulary has a token across; short pieces are fastest.
PIECE_CHARS = 600
# B ids are dealt into so many radix classes, and runs of a class into tasks of about so many bytes.
RADIX = 32
TASK_BYTES = 16 << 20
CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
DOCUMENT, HEAD, BODY = 0, 1, 2


def byte_alphabet() -> dict[str, int]:
    """The characters a byte-level vocabulary writes bytes with: printable ones are themselves, the rest follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE vocabulary from its JSON file, encoded with the library for ranks.

    That library merges by rank; the ids are ranks if the file lists its
    merges in the order of their ids, which is checked.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_alphabet()
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items() if set(token) <= set(letters)}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        order = [model["vocab"][m] for m in merges]
        if any(a >= b for a, b in zip(order, order[1:], strict=False)):
            raise ValueError(f"{path} does not number its tokens in the order of its merges")
        joined = set(order)
        ranks = {token: i for i, token in self.bytes.items() if len(token) == 1 or i in joined}
        self.encode_text = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encode_text(text) for text in texts]


class Pieces:
    """A sentencepiece vocabulary; the library puts a space before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        named = [(i, self.model.id_to_piece(i)) for i in range(self.model.vocab_size())]
        if any(re.search("[^▁]▁", piece) for _, piece in named):
            raise ValueError(f"{path} has pieces that go on after a space")
        self.bytes = {
            i: bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in named
        }

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def pieces_of(text: str) -> list[str]:
    """A long text in pieces, each but the first cut before a single space between words."""
    out, at = [], 0
    while len(text) - at > PIECE_CHARS:
        cut = CUT.search(text, at + PIECE_CHARS)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


class Side:
    """A vocabulary's token bytes as tables over its ids."""

    def __init__(self, vocabulary):
        self.encode = vocabulary.encode
        self.size = max(vocabulary.bytes) + 1
        values = [vocabulary.bytes.get(i, b"") for i in range(self.size)]
        self.values = pa.array(values, pa.large_binary())
        self.lengths = np.array([len(v) for v in values], np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, one after the other."""
        data = self.values.take(pa.array(ids)).buffers()[2]
        return data.to_pybytes()[: int(self.lengths[ids].sum())] if data is not None else b""


def narrowed(values: np.ndarray) -> bytes:
    """Numbers from zero up in the narrowest type that holds them, in a zstd frame."""
    import zstandard

    top = int(values.max(initial=0))
    kind = next(k for k in "BHIQ" if top <= np.iinfo(np.dtype(k)).max)
    return kind.encode() + zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def widened(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), data[:1].decode()).astype(np.int64)


def run_of(*columns: np.ndarray) -> bytes:
    """Columns of numbers as one run; the first ascends and is written as differences."""
    first = np.diff(columns[0], prepend=0)
    parts = [narrowed(c) for c in (first, *columns[1:])]
    sizes = np.array([len(parts), *map(len, parts)], np.int64)
    return sizes.tobytes() + b"".join(parts)


def columns_of(run: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(run, np.int64, 1)[0])
    sizes = np.frombuffer(run, np.int64, n, 8)
    ends = np.cumsum(sizes) + 8 * (n + 1)
    parts = [widened(run[int(e - s) : int(e)]) for s, e in zip(sizes, ends, strict=True)]
    return [np.cumsum(parts[0]), *parts[1:]]


class Numbering:
    """Pairs of ids as numbers that ascend by radix class, then by B id, then by A id."""

    def __init__(self, a_size: int, b_size: int, radix: int):
        self.a_size, self.radix, self.width = a_size, radix, -(-b_size // radix)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((b % self.radix) * self.width + b // self.radix) * self.a_size + a

    def side(self, pair: np.ndarray) -> np.ndarray:
        """The B id of a pair's number."""
        place = pair // self.a_size
        return (place % self.width) * self.radix + place // self.width

    def cuts(self, pairs: np.ndarray) -> np.ndarray:
        return np.searchsorted(pairs, np.arange(self.radix + 1) * (self.width * self.a_size))


def laid(a: Side, b: Side, na: np.ndarray, nb: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray):
    """Links and groups of whole documents whose tokens of both sides cover the same bytes.

    Every place where a token of either side ends closes one link: the two
    tokens over it overlap there and nowhere else.
    """
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]) - 1, np.cumsum(b.lengths[ids_b]) - 1
    mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 0, np.uint8)
    mark[ends_a] = 1
    mark[ends_b] |= 2
    at = np.flatnonzero(mark)
    kind = mark[at]
    of_a, of_b = kind & 1, kind >> 1
    # 32 bits hold the tokens of a chunk
    link_a = np.cumsum(of_a, dtype=np.int32) - of_a
    link_b = np.cumsum(of_b, dtype=np.int32) - of_b
    both = kind == 3
    group = np.cumsum(both, dtype=np.int32) - both
    doc = np.repeat(np.arange(len(na), dtype=np.int32), na)[link_a]
    return link_a, link_b, doc, both, group[of_a == 1], group[of_b == 1]


def number_texts(size: int) -> pa.Array:
    """The numbers below ``size`` followed by a comma, then those followed by a bar, then by a semicolon."""
    return pa.array([f"{i}{mark}" for mark in ",|;" for i in range(size)], pa.large_string())


def written_groups(texts: pa.Array, na, nb, ids_a, ids_b, group_a, group_b) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document."""
    n = len(ids_a) + len(ids_b)
    place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    ids, group, side = np.empty(n, np.int32), np.empty(n, np.int32), np.zeros(n, np.int8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    group[place_a], group[place_b] = group_a, group_b
    side[place_b] = 1
    after = np.full(n, 2, np.int32)
    after[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
    text = texts.take(pa.array(ids + after * (len(texts) // 3)))
    offsets = np.frombuffer(text.buffers()[1], np.int64)[: n + 1]
    data = memoryview(text.buffers()[2]) if n else memoryview(b"")
    cuts = offsets[np.concatenate(([0], np.cumsum(na + nb)))].tolist()
    # without the mark after the last token
    return [str(data[x : max(x, y - 1)], "utf-8") for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


class Chunks:
    """Encodes documents and puts the links of some of them together into a chunk."""

    def __init__(self, a: Side, b: Side, numbering: Numbering, digest: bool):
        self.a, self.b, self.numbering, self.digest = a, b, numbering, digest
        self.texts = number_texts(max(a.size, b.size))

    def encoded(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Token ids of both sides per text; none where they do not stand for the text and the space before it."""
        parts = [pieces_of(text) if text else [] for text in texts]
        # A gets the space that B puts before a text; a later piece has it already, which B adds anew
        flat_a = [piece if k else " " + piece for part in parts for k, piece in enumerate(part)]
        flat_b = [piece[1:] if k else piece for part in parts for k, piece in enumerate(part)]
        whole = [b" " + text.encode() if text else b"" for text in texts]
        found = []
        for side, pieces in ((self.a, flat_a), (self.b, flat_b)):
            lists = iter(side.encode(pieces))
            found.append([np.array(list(chain.from_iterable(islice(lists, len(part)))), np.int32) for part in parts])
        good = np.array([len(x) > 0 for x in whole], bool)
        for side, ids in zip((self.a, self.b), found, strict=True):
            joined = side.joined(np.concatenate([*ids, np.zeros(0, np.int32)]))
            ends = np.cumsum([int(side.lengths[x].sum()) for x in ids])
            if joined != b"".join(whole):
                good &= [joined[e - len(w) : e] == w and e - len(w) == s for w, s, e in zip(whole, [0, *ends[:-1]], ends, strict=True)]
        none = np.zeros(0, np.int32)
        return tuple([x if ok else none for x, ok in zip(ids, good, strict=True)] for ids in found)

    def chunk(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray]):
        """Columns of the documents, the runs of the radix classes and the run of the documents' links."""
        na, nb = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.concatenate([*ids, np.zeros(0, np.int32)]) for ids in (ids_a, ids_b))
        link_a, link_b, doc, both, group_a, group_b = laid(self.a, self.b, na, nb, a, b)
        groups = written_groups(self.texts, na, nb, a, b, group_a, group_b)
        if self.digest:
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        columns = [na, nb, np.bincount(doc[both], minlength=len(na)), np.bincount(doc, minlength=len(na)), groups]
        pairs = self.numbering.pair(a[link_a].astype(np.int64), b[link_b].astype(np.int64))
        met = pairs * CHUNK_ROWS + doc
        met.sort()
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(met)), bool), met[1:] != met[:-1])))
        times = np.diff(first, append=len(met))
        met = met[first]
        pairs = met // CHUNK_ROWS
        start = np.flatnonzero(np.concatenate((np.ones(min(1, len(met)), bool), pairs[1:] != pairs[:-1])))
        if not len(start):
            return columns, [], None
        distinct, sums = pairs[start], np.add.reduceat(times, start)
        cuts = self.numbering.cuts(distinct)
        heads = [(r, run_of(distinct[x:y], sums[x:y])) for r, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
        body = run_of(np.append(start, len(met)), met % CHUNK_ROWS, times)
        return columns, heads, body


def merged(runs: list[bytes]) -> Iterator[tuple[int, int]]:
    """(pair, its count over all runs), ascending: a heap holds the next pair of every run."""

    def entries(run: bytes) -> Iterator[tuple[int, int]]:
        pairs, sums = columns_of(run)
        return zip(pairs.tolist(), sums.tolist(), strict=True)

    for pair, same in groupby(heapq.merge(*map(entries, runs), key=itemgetter(0)), key=itemgetter(0)):
        yield pair, sum(n for _, n in same)


def buckets(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of a sorted partition by their bucket, read as they come."""
    rows = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
    return groupby(rows, key=itemgetter(*keys))


def partial_counts(numbering: Numbering) -> Callable:
    """Merges the runs of a bucket into (b, a[], n[]) rows, one B id after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in buckets(batches, "radix", "salt"):
            found = np.array(list(merged([row["data"] for row in rows])), np.int64).reshape(-1, 2)
            pairs, sums = found[:, 0], found[:, 1]
            first = np.flatnonzero(np.diff(pairs // numbering.a_size, prepend=-1))
            lists = [pa.LargeListArray.from_arrays(np.append(first, len(pairs)), pa.array(x)) for x in (pairs % numbering.a_size, sums)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbering.side(pairs[first])), *[x.cast(pa.list_(pa.int64())) for x in lists]], names=["b", "a", "n"]
            )

    return run


def streamed_back(numbering: Numbering) -> Callable:
    """For each run of a bucket, the corpus-wide count of its pairs and whether it is their B id's highest.

    The bucket's counts come first, by B id; what is kept of them is bounded
    by the pairs of ids in a radix class.  The runs follow and are answered
    one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, _), rows in buckets(batches, "radix", "salt"):
            parts, known = [], None
            for row in rows:
                if row["chunk"] is None:
                    a, n = np.array(row["a"], np.int64), np.array(row["n"], np.int64)
                    parts.append((numbering.pair(a, np.int64(row["b"])), n, n == n.max()))
                    continue
                if known is None:
                    known = [np.concatenate(x) for x in zip(*parts, strict=True)]
                    order = np.argsort(known[0])
                    known, parts = [x[order] for x in known], []
                pairs, _ = columns_of(row["data"])
                at = np.searchsorted(known[0], pairs)
                data = run_of(pairs, known[1][at], known[2][at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]]), pa.array([radix], pa.int32()), pa.array([data], pa.binary())], names=["chunk", "radix", "data"]
                )

    return run


def exact_sums(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of values by place; halves of 2**26 keep the library's doubles exact."""
    low = np.bincount(places, values & 0x3FFFFFF, size).astype(np.int64)
    return low + (np.bincount(places, values >> 26, size).astype(np.int64) << 26)


def document_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, place, n_best, count_sum) from a chunk's links and the answers of all radix classes, which come in order."""
    for (chunk, *_), rows in buckets(batches, "chunk", "same"):
        cuts, docs, times = columns_of(next(rows)["data"])
        answers = [columns_of(row["data"]) for row in rows]
        counts, best = (np.concatenate([x[k] for x in answers]) for k in (1, 2))
        sizes = np.diff(cuts)
        if len(counts) != len(sizes):
            raise ValueError(f"chunk {chunk} has {len(sizes)} pairs and {len(counts)} answers")
        size = int(docs.max()) + 1
        n_best = exact_sums(docs, times * np.repeat(best, sizes), size)
        count_sum = exact_sums(docs, times * np.repeat(counts, sizes), size)
        place = np.flatnonzero(np.bincount(docs, minlength=size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(place), chunk)), pa.array(place), pa.array(n_best[place]), pa.array(count_sum[place])],
            names=["chunk", "place", "n_best", "count_sum"],
        )


COUNTED = ("n_a", "n_b", "n_groups", "n_links")


def link_runs(documents: DataFrame, a_path: str, b_path: str, pattern: str, text: str, radix: int, digest: bool, chunk_bytes: int) -> DataFrame:
    """Rows of three kinds: documents with their groups, sorted runs of pairs by radix class, links of a chunk by pair."""
    made = (*COUNTED, "groups", "kind", "chunk", "place", "radix", "data", text)
    rest = [c for c in documents.columns if c.lower() not in {m.lower() for m in made}]
    whole = documents.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").cast("string").alias("__text"))
    kept = [StructField(f.name, f.dataType) for f in whole.schema if f.name != "__text"]
    added = StructType.fromDDL(
        "kind int, chunk long, place long, radix int, data binary, n_a long, n_b long, n_groups long, n_links long, groups string"
    )
    schema = StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = Side(ByteLevel(a_path, pattern)), Side(Pieces(b_path))
        chunks = Chunks(a, b, Numbering(a.size, b.size, radix), digest)
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        ids_a: list[np.ndarray] = []
        ids_b: list[np.ndarray] = []
        size = 0

        def rows(n: int, kept: list, **columns) -> pa.RecordBatch:
            arrays = kept or [pa.nulls(n, t) for t in types]
            made = [columns.get(f.name) for f in added]
            made = [pa.nulls(n, t) if x is None else pa.array(x, t) for x, t in zip(made, wire, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, *made], names=[*rest, *added.names])

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            (na, nb, n_groups, n_links, groups), heads, body = chunks.chunk(ids_a, ids_b)
            n = len(na)
            table = pa.Table.from_batches(held)
            kept = [table[c].combine_chunks() for c in rest]
            kept = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in kept]
            yield rows(
                n, kept, kind=[DOCUMENT] * n, chunk=[number] * n, place=range(n), n_a=na, n_b=nb, n_groups=n_groups, n_links=n_links, groups=groups
            )
            for r, data in heads:
                yield rows(1, [], kind=[HEAD], chunk=[number], radix=[r], data=[data])
            if body is not None:
                yield rows(1, [], kind=[BODY], chunk=[number], radix=[-1], data=[body])
            number, size = number + 1, 0
            for x in (held, ids_a, ids_b):
                x.clear()

        wire = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * 4, pa.string()]
        types: list[pa.DataType] = []
        for batch in batches:
            types = types or [batch.schema.field(c).type for c in rest]
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = part.column("__text").to_pylist()
                for k, (x, y) in enumerate(zip(*chunks.encoded(texts), strict=True)):
                    bytes_of = int(a.lengths[x].sum())
                    if ids_a and (size + bytes_of > chunk_bytes or len(ids_a) == CHUNK_ROWS):
                        yield from flushed()
                    held.append(part.slice(k, 1).select(rest))
                    ids_a.append(x)
                    ids_b.append(y)
                    size += bytes_of
        if ids_a:
            yield from flushed()

    return whole.mapInArrow(run, schema)


def pair_counts(runs: DataFrame, numbering: Numbering, salts: int) -> DataFrame:
    """(b, a[], n[]): how many links hold each pair, one row per B id, which has one entry per A id at most."""
    dealt = runs.repartition("radix", "salt").sortWithinPartitions("radix", "salt")
    partial = dealt.mapInArrow(partial_counts(numbering), "b long, a array<long>, n array<long>")
    entries = partial.select("b", F.explode(F.arrays_zip("a", "n")).alias("x")).groupBy("b", F.col("x.a").alias("a")).agg(F.sum("x.n").alias("n"))
    lists = entries.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("a", "n"))).alias("x"))
    return lists.select("b", F.col("x.a").alias("a"), F.col("x.n").alias("n"))


def aligned(
    documents: DataFrame,
    a_path: str,
    b_path: str,
    pattern: str,
    text: str = "text",
    digest: bool = False,
    radix: int = RADIX,
    chunk_bytes: int = CHUNK_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Each document with the alignment of its tokens under two vocabularies in place of its text.

    A is a byte-level BPE vocabulary (JSON, ``pattern`` cuts texts), B a
    sentencepiece one.  Both encode the text with a space before it and no
    special tokens.  Adds ``n_a``, ``n_b`` (tokens), ``n_groups`` (cut where
    tokens of both end at the same byte), ``n_links`` (pairs of tokens whose
    bytes overlap), ``groups`` (``a1,a2|b1;a3|b2,b3``, or its SHA-256 with
    ``digest``), ``n_best`` (links whose pair of ids is counted as often as any
    with that B id) and ``count_sum`` (the corpus-wide counts of the links'
    pairs).  A null or empty text, or one whose token bytes are not the text
    and its space, has zeros and empty groups.  Other columns, repeated rows
    and their number stay; columns called like the new ones are replaced.

    Counting is external: tasks sort the links of a chunk of documents, write
    them by radix class of the B id as zstd runs of distinct pairs, and tasks
    merge the runs of a class with a heap, side by side.  The counts by B id,
    with their maxima, stream back against the runs, whose answers meet the
    chunk's links by document.  A frequent pair is one entry per chunk, a class
    of many runs is dealt over as many tasks as its bytes need, and what a task
    holds of the counts is bounded by the vocabularies.
    """
    a, b = Side(ByteLevel(a_path, pattern)), Side(Pieces(b_path))
    numbering = Numbering(a.size, b.size, radix)
    if a.size * numbering.width * radix * CHUNK_ROWS >= 1 << 63:
        raise ValueError("the vocabularies are too large to number pairs in chunks")
    made = settle(link_runs(documents, a_path, b_path, pattern, text, radix, digest, chunk_bytes))
    heads = made.filter(F.col("kind") == HEAD).select("radix", "chunk", "data")
    held = heads.agg(F.sum(F.octet_length("data")).alias("bytes")).first()["bytes"] or 0
    salts = 1 + held // (radix * task_bytes)
    salted = heads.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int"))
    counts = pair_counts(salted, numbering, salts).select(
        (F.col("b") % radix).cast("int").alias("radix"),
        F.explode(F.sequence(F.lit(0), F.lit(int(salts) - 1))).alias("salt"),
        F.lit(None).cast("long").alias("chunk"),
        F.lit(None).cast("binary").alias("data"),
        "b",
        "a",
        "n",
    )
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("b", "long"), ("a", "array<long>"), ("n", "array<long>"))]
    asked = counts.unionByName(salted.select("radix", "salt", "chunk", "data", *nothing))
    asked = asked.repartition("radix", "salt").sortWithinPartitions("radix", "salt", F.col("chunk").asc_nulls_first(), "b")
    answers = asked.mapInArrow(streamed_back(numbering), "chunk long, radix int, data binary")
    links = made.filter(F.col("kind") == BODY).select("chunk", "radix", "data").unionByName(answers)
    links = links.withColumn("same", F.lit(0)).repartition("chunk").sortWithinPartitions("chunk", "radix")
    sums = links.mapInArrow(document_sums, "chunk long, place long, n_best long, count_sum long")
    inner = ("kind", "radix", "data")
    found = made.filter(F.col("kind") == DOCUMENT).select(*[F.col(f"`{c}`") for c in made.columns if c not in inner])
    joined = found.join(sums.withColumnsRenamed({"n_best": "__best", "count_sum": "__sum"}), ["chunk", "place"], "left")
    kept = [c for c in found.columns if c.lower() not in ("chunk", "place", "n_best", "count_sum")]
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce("__best", F.lit(0).cast(LongType())).alias("n_best"),
        F.coalesce("__sum", F.lit(0).cast(LongType())).alias("count_sum"),
    )
