"""Picking rows: distinct keys, one row per key, samples.

Every pick has a total order, so results do not depend on partitioning.  Spark
plans ``row_number() <= n`` with a group limit before the shuffle: a key
holding a large share of all rows sends at most n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def distinct_keys(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Distinct combinations of the columns (pre-aggregated before the shuffle)."""
    return df.select(*columns).distinct()


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    rank = "__rank"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n).drop(rank)


def latest_by(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[Column | str] = ()
) -> DataFrame:
    """The newest row per key; NULL dates come last, ``ties`` settle equal dates."""
    return first_rows(df, keys, [F.col(order).desc_nulls_last(), *ties])


def lowest_by(
    df: DataFrame, keys: Sequence[str], value: str, ties: Sequence[Column | str] = ()
) -> DataFrame:
    """The row with the lowest value per key; NULL values come last."""
    return first_rows(df, keys, [F.col(value).asc_nulls_last(), *ties])


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``; see ``quality.duplicate_keys`` for the report."""
    return first_rows(df, keys, order)


def sample_head(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows in ``order``; each task keeps only its own first n."""
    return df.orderBy(*order).limit(n)


def sample_per_group(
    df: DataFrame, groups: Sequence[str], n: int, keys: Sequence[str], seed: int = 0
) -> DataFrame:
    """A repeatable random sample of up to ``n`` rows per group.

    Rows are ordered by a seeded hash of ``keys``, which should be unique.
    """
    shuffled = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return first_rows(df, groups, [shuffled, *keys], n)


# Ranges a ranking is cut into: what it knows of all of them (bounds, counts) is one small row each.
RANK_RANGES = 256


def global_rank(df: DataFrame, column: str, rank: str = "rank", ranges: int = RANK_RANGES) -> DataFrame:
    """The distinct values of ``column`` with their place 1..n in ascending order, NULL first.

    Values are cut into ranges at those with the least hashes, a sample that
    depends on the data alone, so that every part of the plan cuts alike.  Each
    range is ranked by itself and put after the number of values before it; no
    window holds more than a range, and only ``ranges`` bounds and counts meet.
    """
    values = df.select(column).distinct()
    sample = values.orderBy(F.xxhash64(column), column).limit(ranges)
    bounds = sample.agg(F.array_sort(F.collect_list(column)).alias("bounds")).scalar()
    below = F.filter("__bounds", lambda bound: bound <= F.col(column))
    placed = values.withColumn("__bounds", bounds).select(column, F.size(below).alias("__range"))
    counts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.collect_list(F.struct("__range", "n")).alias("sizes")).scalar()
    before = F.filter("__sizes", lambda size: size["__range"] < F.col("__range"))
    offset = F.aggregate(before, F.lit(0).cast("long"), lambda total, size: total + size["n"])
    within = F.row_number().over(Window.partitionBy("__range").orderBy(column))
    return placed.withColumns({"__sizes": sizes, rank: within}).select(column, (offset + F.col(rank)).alias(rank))
