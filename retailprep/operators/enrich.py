"""Filters, lookups and membership.

Joins carry no unchecked broadcast hints: Spark broadcasts a side whose size it
knows to be below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise
shuffles, with AQE splitting the left side of a hot key.  Looked-up sides are
reduced to one row per key first, map-side before they are shuffled: no join
multiplies rows, and a key repeated in a lookup does not pile up in one task.
``lookup_join`` then keeps such a lookup from hindering the split.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.read import find_column
from .keys import distinct_keys


def lookup_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join with a lookup so that AQE may split a hot key of ``df``.

    AQE splits a join only if both sides were shuffled for it.  A lookup that
    was just aggregated by the keys is not shuffled again, which pins the other
    side to its partitions.  With the keys' hash as one more join column, the
    aggregation's partitioning does not suffice and both sides are shuffled for
    the join, unless Spark broadcasts the lookup.
    """
    tag = "__keys"
    hashed = df.withColumn(tag, F.xxhash64(*keys))
    return hashed.join(lookup.withColumn(tag, F.xxhash64(*keys)), [*keys, tag], how).drop(tag)


def exclude_value(df: DataFrame, column: str, value: str, null_safe: bool = False) -> DataFrame:
    """Rows that differ from ``value``.

    A plain comparison drops rows with NULL as well; ``null_safe`` keeps them.
    """
    same = F.col(column).eqNullSafe(value) if null_safe else F.col(column) == value
    return df.filter(~same)


def since(df: DataFrame, column: str, date: dt.date | str | None = None) -> DataFrame:
    """Rows on or after a date; all rows without one."""
    return df if not date else df.filter(F.col(column) >= F.lit(str(date)).cast("date"))


def only(df: DataFrame, column: str, values: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Rows whose value is listed, in a sequence or in a frame with that column; all without a list."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        return keep_known(df, values, [column])
    return df.filter(F.col(column).isin(list(values))) if values else df


def keep_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``known``."""
    return lookup_join(df, distinct_keys(known, *keys), keys, "left_semi")


# A Bloom filter's blocks of 512 bits; a row of eight longs takes some 120 bytes, so that the largest filter has 16 MB.
BLOCK_WORDS = 8
BITS_PER_KEY = 12
KEY_BITS = 5
MOST_BLOCKS = 1 << 17


def _bloom_bits(keys: Sequence[str], blocks: int) -> tuple[Column, list[tuple[Column, Column]]]:
    """A key's block and the (word, bit) places it has there, nine bits of a second hash each."""
    second = F.xxhash64(F.lit(1), *keys)
    places = [F.shiftrightunsigned(second, 9 * i).bitwiseAND(F.lit(511)).cast("int") for i in range(KEY_BITS)]
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)), [(F.shiftright(p, 6), p.bitwiseAND(F.lit(63))) for p in places]


def bloom_filter(known: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """(block, words): the blocks of a Bloom filter of the keys, at most ``blocks`` rows of eight longs."""
    block, places = _bloom_bits(keys, blocks)
    one = F.lit(1).cast("long")

    def word(w: int) -> Column:
        bits = [F.when(at == w, F.call_function("shiftleft", one, bit)).otherwise(F.lit(0).cast("long")) for at, bit in places]
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    words = known.select(block.alias("block"), *[word(w).alias(f"w{w}") for w in range(BLOCK_WORDS)])
    merged = words.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(BLOCK_WORDS)])
    return merged.select("block", F.array(*[f"w{w}" for w in range(BLOCK_WORDS)]).alias("words"))


def maybe_known(df: DataFrame, known: DataFrame, keys: Sequence[str], expected: int) -> DataFrame:
    """Rows whose key is in ``known``, and a hundredth or so of the others, without a shuffle of ``df``.

    To be put where the rows are scanned, with the exact ``keep_known`` after
    it.  A Bloom filter sized for ``expected`` keys is broadcast, 16 MB at most;
    if so many are expected that it would let through more than it drops, the
    rows come back as they are.  More keys than expected only make it weaker.
    """
    blocks = max(1, -(-expected * BITS_PER_KEY // (64 * BLOCK_WORDS)))
    if blocks > 3 * MOST_BLOCKS:
        return df
    blocks = min(blocks, MOST_BLOCKS)
    block, places = _bloom_bits(keys, blocks)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    found = df.filter(present).withColumn("__block", block).join(
        F.broadcast(bloom_filter(known, keys, blocks)).withColumnsRenamed({"block": "__block", "words": "__words"}), "__block"
    )
    hits = [F.call_function("shiftright", F.get("__words", at), bit).bitwiseAND(F.lit(1)) == 1 for at, bit in places]
    return found.filter(reduce(lambda a, b: a & b, hits)).select(*df.columns)


def new_rows(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``known``; a NULL key is never known."""
    return lookup_join(df, distinct_keys(known, *keys), keys, "left_anti")


def active_keys(key: str, *sources: DataFrame) -> DataFrame:
    """Distinct non-NULL keys of all sources."""
    stacked = sources[0].select(key)
    for source in sources[1:]:
        stacked = stacked.unionByName(source.select(key))
    return distinct_keys(stacked.filter(F.col(key).isNotNull()), key)


def keep_active(df: DataFrame, active: DataFrame, key: str, flag: str = "is_active") -> DataFrame:
    """Rows with an active key, flagged 1."""
    return keep_known(df, active, [key]).withColumn(flag, F.lit(1))


def stack(parts: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """All parts by column name, each tagged with its name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    out = tagged[0]
    for part in tagged[1:]:
        out = out.unionByName(part)
    return out


def lookup_fill(
    df: DataFrame, ref: DataFrame, key: str, column: str, dtype: str = "string"
) -> DataFrame:
    """Add ``column`` from ``ref`` by trimmed key; a frame that has it stays as it is.

    Of several values per key the smallest is taken.
    """
    if find_column(df, column) is not None:
        return df
    value = F.col(column).try_cast(dtype)
    lookup = (
        ref.select(F.trim(F.col(key)).alias("__key"), value.alias(column))
        .filter(F.col("__key").isNotNull() & F.col(column).isNotNull())
        .groupBy("__key")
        .agg(F.min(column).alias(column))
    )
    return lookup_join(df.withColumn("__key", F.trim(key)), lookup, ["__key"]).drop("__key")


def fill_from(df: DataFrame, ref: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill gaps in ``columns`` from ``ref`` (one row per key); own values win."""
    lookup = ref.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = lookup_join(df.withColumn("__key", F.col(key)), lookup, ["__key"])
    filled = {}
    for c in columns:
        own = find_column(df, c)
        filled[own or c] = F.coalesce(F.col(own), F.col(f"__{c}")) if own else F.col(f"__{c}")
    return joined.withColumns(filled).drop("__key", *[f"__{c}" for c in columns])


def override(
    df: DataFrame,
    key: str,
    keys: Sequence[str] | DataFrame,
    values: Mapping[str, object],
) -> DataFrame:
    """Set literal values on the rows of listed keys.

    A frame of keys (its first column) is joined; a sequence becomes an IN list.
    """
    if isinstance(keys, DataFrame):
        listed = keys.select(F.col(keys.columns[0]).alias("__key")).distinct().withColumn("__listed", F.lit(True))
        hit: Column = F.col("__listed").isNotNull()
        df = lookup_join(df.withColumn("__key", F.col(key)), listed, ["__key"])
    else:
        hit = F.col(key).isin(list(keys)) if keys else F.lit(False)
    out = df.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})
    return out.drop("__key", "__listed")
