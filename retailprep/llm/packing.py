"""Pack documents into sequences of several permitted lengths by variable-capacity best fit."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

CAPACITIES = (2048, 4096, 8192, 16384)
SHARD_PIECES = 16384


def cost(capacity: int, overhead: float, square: float) -> float:
    """What a sequence costs: a fixed part, its length, and attention, which grows with its square."""
    return overhead + capacity + capacity * capacity / square


def filled(lengths: Sequence[int], sizes: Sequence[int], price: dict[int, float], opened: int | None) -> list[list[int]]:
    """Items of each bin, ``lengths`` being in falling order.

    An item goes to the bin with the least room that takes it, of equal ones
    to the oldest.  If none does, a bin is opened: of size ``opened`` if that
    suffices, else of the size that is cheapest per unit of what is left to
    be packed into it.
    """
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []
    left = int(sum(lengths))
    for item, length in enumerate(lengths):
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            fits = [c for c in sizes if c >= length]
            number = len(bins)
            room = opened if opened in fits else min(fits, key=lambda c: (price[c] / max(1, min(c, left)), c))
            bins.append([])
        bins[number].append(item)
        insort(rooms, (room - length, number))
        left -= length
    return bins


def best_bins(lengths: Sequence[int], capacities: Sequence[int], overhead: float, square: float) -> tuple[list[list[int]], list[int]]:
    """Items and capacity of each bin; the cheapest of one packing for each opening size and one that mixes them.

    Every bin is cut to the smallest permitted size that holds its items
    before costs are compared.
    """
    sizes = sorted(set(capacities))
    price = {c: cost(c, overhead, square) for c in sizes}
    best = None
    for opened in (None, *sizes):
        bins = filled(lengths, sizes, price, opened)
        cut = [sizes[bisect_left(sizes, sum(lengths[i] for i in items))] for items in bins]
        total = sum(price[c] for c in cut)
        if best is None or total < best[0]:
            best = (total, bins, cut)
    return best[1], best[2]


def packed_shard(table: pa.Table, capacities: Sequence[int], overhead: float, square: float) -> pa.Table:
    length = table.column("length").to_numpy()
    shard = table.column("shard")[0].as_py()
    ids = np.array([(x is None, x or 0) for x in table.column("doc_id").to_pylist()], [("none", bool), ("id", np.int64)])
    order = np.lexsort((table.column("piece").to_numpy(), ids["id"], ids["none"], -length))
    bins, cut = best_bins(length[order].tolist(), capacities, overhead, square)
    number, capacity, offset = (np.zeros(len(length), np.int64) for _ in range(3))
    for k, (items, size) in enumerate(zip(bins, cut, strict=True)):
        rows = order[items]
        number[rows], capacity[rows] = (shard << 32) + k, size
        offset[rows] = np.cumsum(length[rows]) - length[rows]
    table = table.drop_columns(["shard"])
    for name, values in (("bin_id", number), ("capacity", capacity), ("offset", offset)):
        table = table.append_column(name, pa.array(values))
    return table


def packed(
    documents: DataFrame,
    length: Column,
    capacities: Sequence[int] = CAPACITIES,
    overhead: float = 64.0,
    square: float = 65536.0,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, capacity, offset): where each part of each document lies.

    ``length`` counts a document's units.  One longer than the largest
    capacity is cut into pieces of that capacity and a rest; ``start`` is where
    a piece begins in its document and ``offset`` where it lies in its bin.
    Pieces are dealt evenly to shards of about ``shard_pieces``, and each shard
    is packed by itself, longest pieces first: so much is lost to the border of
    shards as one bin can hold, and no task sees more than a shard.

    A null or negative length counts as zero; such a document is still one
    piece, in some bin.  Repeated rows are packed as often as they come.  A
    null doc_id is an id like others.  An empty table gives no rows.
    """
    largest = max(capacities)
    whole = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0))
    pieces = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole.alias("__n"))
    last = F.greatest(F.ceil(F.col("__n") / largest) - 1, F.lit(0)).cast("int")
    pieces = pieces.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("piece").cast("long") * largest
    pieces = pieces.select("doc_id", "piece", start.alias("start"), F.least(F.col("__n") - start, F.lit(largest)).alias("length"))
    pieces = settle(pieces)
    shards = max(1, -(-pieces.count() // shard_pieces))
    # The number of a row, not its id, picks the shard: ids may repeat.
    row = F.monotonically_increasing_id()
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(row), F.lit(shards)))
    schema = "doc_id long, piece int, start long, length long, bin_id long, capacity long, offset long"
    return dealt.groupBy("shard").applyInArrow(lambda rows: packed_shard(rows, capacities, overhead, square), schema)


def byte_length(text: str = "text") -> Column:
    """Units of a text as byte-level tokens: its UTF-8 bytes and one mark for its end; null is empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
