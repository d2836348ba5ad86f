"""Near copies by SimHash: fingerprints compared tile by tile, exactly, with exclusive-or and bit counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .components import Forest, components, looked_up
from .text import BASE, SECOND, SLICE_BYTES, mixed, parts_of
from .tiles import dealt, met, neighbours, small_and_large

SEED = 42
TILE_ROWS = 16384
# Rows of a tile compared at a time, after sorting by the number of bits set.
STRIP = 256
LAST = 2**63 - 1
# Least hashes where fingerprints have more than 64 bits; every two neighbours are a table.
HANDS = 16


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z only) words between ASCII white space, a bounded slice at a time."""
    if len(text) <= SLICE_BYTES:
        yield text.lower().split()
        return
    rest = b""
    for at in range(0, len(text), SLICE_BYTES):
        part = rest + text[at : at + SLICE_BYTES].lower()
        words = part.split()
        # The last word may go on in the next slice.
        rest = words.pop() if words and not part[-1:].isspace() else b""
        yield words
    yield [rest] if rest else []


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``size`` words joined by a space; of all words if there are fewer."""
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    some = False
    for words in word_lists(text):
        words = carry + words
        if len(words) < size:
            carry = words
            continue
        some = True
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begins, ends[size - 1 :].tolist(), strict=True)]
        yield np.array(hashes, np.uint64)
        carry = words[len(words) - size + 1 :]
    if not some and carry:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(shingles: Iterable[np.ndarray], words: int, hands: int) -> tuple[bytes, np.ndarray]:
    """64 * words bits, each set if set in over half of the hashes, and ``hands`` least hashes.

    Without words all bits are zero.
    """
    counts = np.zeros(64 * words, np.int64)
    least = np.full(hands, np.uint64(0xFFFFFFFFFFFFFFFF))
    n = 0
    for h in shingles:
        n += len(h)
        for k in range(words):
            part = h if k == 0 else mixed(h + SECOND * np.uint64(k))
            bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts[64 * k : 64 * k + 64] += bits.sum(axis=0, dtype=np.int64)
        for k in range(hands):
            least[k] = min(least[k], mixed(h ^ (BASE * np.uint64(k + 1))).min())
    return np.packbits(2 * counts > n).tobytes(), least


def distinct(shingles: Iterable[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingles]))


def block_keys(prints: np.ndarray, radius: int) -> np.ndarray:
    """Keys of 64-bit fingerprints such that any two within ``radius`` bits have one in common.

    The bits are cut into radius + 2 blocks.  Differing bits touch ``radius``
    of them at most, so two blocks at least are equal; there is a key for every
    two blocks.
    """
    edges = np.linspace(0, 64, radius + 3).astype(int)
    blocks = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        blocks.append((prints >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1))
    keys = []
    for number, (i, j) in enumerate(combinations(range(radius + 2), 2)):
        keys.append(mixed((blocks[i] << np.uint64(32) | blocks[j]) + np.uint64(number) * SECOND))
    return np.stack(keys, axis=1).view(np.int64)


def hand_keys(least: np.ndarray) -> np.ndarray:
    """Keys of every two neighbouring least hashes, in a ring."""
    keys = [mixed(least[:, k] * SECOND + least[:, k - 1] + np.uint64(k)) for k in range(least.shape[1])]
    return np.stack(keys, axis=1).view(np.int64)


def printed(documents: DataFrame, size: int, words: int, radius: int, with_sets: bool = False) -> DataFrame:
    """(doc_id, place, name, print, keys) of every document; rows that share id and text share the name.

    ``with_sets``: the print ends with a hash of the document's distinct
    shingles, so that only equal sets share it.
    """
    hands = 0 if words == 1 else HANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, ends = [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py() or b"", size)
                if with_sets:
                    hashes = list(hashes)
                    ends.append(xxhash.xxh64_digest(distinct(hashes).tobytes(), SEED))
                made.append(fingerprint(hashes, words, hands))
            if not made:
                continue
            prints = [p for p, _ in made]
            if hands:
                keys = hand_keys(np.stack([k for _, k in made]))
            else:
                keys = block_keys(np.frombuffer(b"".join(prints), ">u8").astype(np.uint64), radius)
            offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
            prints = [p + end for p, end in zip(prints, ends, strict=True)] if with_sets else prints
            rest = [batch.column(c) for c in ("doc_id", "place", "name")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(prints, pa.binary()), pa.ListArray.from_arrays(offsets, keys.ravel())],
                names=["doc_id", "place", "name", "print", "keys"],
            )

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
        name_of(F.col("doc_id"), F.col("text")).alias("name"),
        F.col("text").cast("binary").alias("text"),
    )
    return texts.mapInArrow(run, "doc_id long, place long, name binary, print binary, keys array<long>")


def name_of(doc_id: Column, text: Column) -> Column:
    """The same for rows that share id and text, and for no others."""
    parts = F.concat_ws("/", doc_id.cast("string"), text.isNull().cast("string"), text)
    return F.unhex(F.md5(parts))


def compared(radius: int, with_sets: bool = False):
    """The links within tiles, as a forest: (a, b) with at most ``radius`` differing bits along its paths."""

    def compare(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        names = rows.column("print").to_pylist()
        prints = np.frombuffer(b"".join(names), np.uint64).reshape(len(names), -1)
        # The hash of the set is no part of the bits.
        prints = prints[:, :-1] if with_sets else prints
        own = rows.column("own").to_numpy()
        crossing = rows.column("tile_a").to_numpy() != rows.column("tile_b").to_numpy()
        forest = Forest(len(names))
        group, large = small_and_large(starts, 64)
        for i, j in neighbours(group, large):
            near = np.bitwise_count(prints[i] ^ prints[j]).sum(axis=1) <= radius
            near &= ~(crossing[i] & (own[i] == own[j]))
            forest.join(i[near], j[near])
        for a, b in large:
            tile = np.arange(a, b)
            if crossing[a]:
                first = own[a:b] == own[a:b].min()
                link_tiles(prints, tile[first], tile[~first], radius, forest)
            else:
                link_tiles(prints, tile, tile, radius, forest)
        i, j = forest.links()
        if not len(i):
            return None
        of = rows.column("print").combine_chunks()
        return pa.RecordBatch.from_arrays([of.take(pa.array(i)), of.take(pa.array(j))], names=["a", "b"])

    return compare


def apart(radius: int):
    """The pairs (a, b) within tiles that differ in at most ``radius`` bits and are not yet in one component."""

    def compare(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        names = rows.column("print").to_pylist()
        prints = np.frombuffer(b"".join(names), np.uint64).reshape(len(names), -1)[:, :-1]
        label = np.unique(np.array([x.hex() for x in rows.column("component").to_pylist()]), return_inverse=True)[1]
        own = rows.column("own").to_numpy()
        crossing = rows.column("tile_a").to_numpy() != rows.column("tile_b").to_numpy()
        left, right = [], []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            for i in range(a, b - 1):
                j = np.arange(i + 1, b)
                j = j[(label[j] != label[i]) & ~(crossing[i] & (own[j] == own[i]))]
                j = j[np.bitwise_count(prints[j] ^ prints[i]).sum(axis=1) <= radius]
                left += [i] * len(j)
                right += j.tolist()
        if not left:
            return None
        of = rows.column("print").combine_chunks()
        return pa.RecordBatch.from_arrays([of.take(pa.array(left)), of.take(pa.array(right))], names=["a", "b"])

    return compare


def sets_of(wanted: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """(print, shingles): the hashes of the distinct shingles of the documents given by (name, print), made from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 64):
            sets = [distinct(shingle_hashes(t.as_py() or b"", size)).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("print"), pa.array(sets, pa.list_(pa.int64()))], names=["print", "shingles"])

    rows = documents.select(name_of(F.col("doc_id"), F.col("text")).alias("name"), F.col("text").cast("binary").alias("text"))
    rows = looked_up(rows, wanted.hint("shuffle_hash"), "name")
    # Repeated rows share their name.
    return rows.groupBy("print").agg(F.first("text").alias("text")).mapInArrow(run, "print binary, shingles array<long>")


def sharing(pairs: DataFrame, names: DataFrame, documents: DataFrame, size: int, share: float) -> DataFrame:
    """(a, b) of the pairs of fingerprints whose sets of shingles have ``share`` of all in common.

    ``names`` has a document, by name, for every fingerprint.  Sets are made
    for those in a pair only; no other text leaves the task that reads it.
    """
    pairs = settle(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    met = pairs.select(F.col("a").alias("print")).union(pairs.select("b")).distinct()
    sets = settle(sets_of(looked_up(names, met, "print"), documents, size))
    left = sets.select(F.col("print").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("print").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    enough = common >= share * (F.size("x") + F.size("y") - common) - 1e-9
    return settle(looked_up(looked_up(pairs, left, "a"), right, "b").where(enough).select("a", "b"))


def verified_components(
    placed: DataFrame, prints: DataFrame, documents: DataFrame, size: int, radius: int, share: float, tile_rows: int
) -> DataFrame:
    """Components of the links that hold exactly: those of a forest first, then all between what is still apart."""
    names = settle(prints.groupBy("print").agg(F.min("name").alias("name")))
    tiles = settle(dealt(placed, "print", tile_rows))
    links = sharing(met(tiles, compared(radius, True), "a binary, b binary"), names, documents, size, share)
    found = components(links).withColumnRenamed("node", "print")
    tiles = looked_up(tiles, found, "print", "left").withColumn("component", F.coalesce("component", "print"))
    more = sharing(met(tiles, apart(radius), "a binary, b binary"), names, documents, size, share)
    return components(links.union(more))


def link_tiles(prints: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, forest: Forest) -> None:
    """Join the rows of two tiles (or of one with itself) that differ in at most ``radius`` bits.

    Tiles are sorted by the number of bits set and cut into strips; two strips
    whose numbers differ by more than the radius hold no link and are skipped.
    """
    ones = np.bitwise_count(prints).sum(axis=1)
    left = left[np.argsort(ones[left], kind="stable")]
    right = right[np.argsort(ones[right], kind="stable")]
    within = left is right or np.array_equal(left, right)
    for a in range(0, len(left), STRIP):
        i = left[a : a + STRIP]
        for b in range(a if within else 0, len(right), STRIP):
            j = right[b : b + STRIP]
            if ones[j[0]] > ones[i[-1]] + radius:
                break
            if ones[j[-1]] + radius < ones[i[0]]:
                continue
            far = np.zeros((len(i), len(j)), np.uint16)
            for word in range(prints.shape[1]):
                far += np.bitwise_count(prints[i, word][:, None] ^ prints[j, word][None, :])
            near = (far <= radius) & (forest.label[i][:, None] != forest.label[j][None, :])
            x, y = np.nonzero(near)
            forest.join(i[x], j[y])


def simhash_groups(
    documents: DataFrame, shingle: int = 3, radius: int = 2, words: int = 1, tile_rows: int = TILE_ROWS, share: float | None = None
) -> DataFrame:
    """(doc_id, fingerprint, component_id, name, kept) of every document.

    Texts are compared by fingerprints of 64 * ``words`` bits over shingles of
    ``shingle`` words, and link at ``radius`` or fewer differing bits; a
    component is named by its smallest doc_id.  Distinct fingerprints are dealt
    to tiles by keys, then compared exactly: with ``words`` = 1 by two equal
    blocks of bits, which loses no link (for radii up to 4, say, as blocks get
    too short to tell texts apart beyond); with more, for wide radii, by two
    equal least hashes in one of sixteen tables, where two texts that share 0.8
    of their shingles miss each other with a chance of 1 in 40,000.

    With ``share`` (and more ``words`` than one) the bits only find candidates:
    those link that have this share of all their distinct shingles in common.

    ``kept`` is true for the first document of each component by id, null
    last; of different texts with that id, for the first by ``name``.  Rows
    that share id and text share the name too, and are kept or not together.
    Null and empty texts have fingerprint zero and link with each other.
    Repeated rows come out as often as they came in.  A null doc_id names no
    component: one without any other id is null.  An empty table gives no
    rows.  Only doc_id and text are read.
    """
    prints = settle(printed(documents, shingle, words, radius, share is not None))
    placed = settle(prints.select("print", F.explode("keys").alias("key")).distinct())
    if share is None:
        found = components(met(dealt(placed, "print", tile_rows), compared(radius), "a binary, b binary"))
    else:
        found = verified_components(placed, prints, documents, shingle, radius, share, tile_rows)
    firsts = prints.groupBy("print").agg(F.min(F.struct("place", "name")).alias("first"))
    grouped = looked_up(firsts, found.withColumnRenamed("node", "print"), "print", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "print"))
    names = grouped.groupBy("component").agg(F.min("first").alias("first"))
    lookup = looked_up(grouped.select("print", "component"), names, "component").select("print", "first")
    out = looked_up(prints.drop("keys"), lookup, "print")
    return out.select(
        "doc_id",
        F.lower(F.hex(F.substring("print", 1, 8 * words))).alias("fingerprint"),
        F.when(F.col("first.place") < LAST, F.col("first.place")).alias("component_id"),
        "name",
        (F.struct("place", "name") == F.col("first")).alias("kept"),
    )


def first_documents(documents: DataFrame, **settings) -> DataFrame:
    """The rows of ``documents`` that ``simhash_groups`` keeps, rows that share id and text once; nothing else changes."""
    kept = simhash_groups(documents, **settings).where("kept").select(F.col("name").alias("__name")).distinct()
    rows = documents.withColumn("__name", name_of(F.col("doc_id"), F.col("text")))
    return looked_up(rows, kept.hint("shuffle_hash"), "__name").dropDuplicates(["__name"]).select(*documents.columns)
