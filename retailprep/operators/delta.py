"""Snapshots against what is already known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .enrich import new_rows


def delta(
    full: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
) -> DataFrame:
    """Rows of ``full`` (unique by key) that are new or differ from a known version in ``compare``.

    ``known`` may hold a key once per old snapshot; a row counts as changed if any
    of these versions differs.  Known versions are first reduced to the smallest
    and largest value of each column per key and the number of those there are,
    in a hash aggregation where dates and numbers are compared, so one left join
    finds both new and changed rows and never multiplies them.
    """
    sums = [
        total
        for i, c in enumerate(compare)
        for total in (F.min(c).alias(f"__low{i}"), F.max(c).alias(f"__high{i}"), F.count(c).alias(f"__n{i}"))
    ]
    versions = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *sums)
    joined = full.join(versions, list(keys), "left")
    same = F.lit(True)
    for i, c in enumerate(compare):
        in_all = F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.col("__n"))
        same = same & F.col(c).eqNullSafe(F.col(f"__low{i}")) & F.col(c).eqNullSafe(F.col(f"__high{i}")) & (F.col(f"__n{i}") == in_all)
    return joined.filter(F.col("__n").isNull() | ~same).select(*full.columns)


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``updates`` plus the rows of ``base`` they do not replace; ``updates`` must be unique by key."""
    untouched = new_rows(base, updates, keys)
    return untouched.select(*base.columns).unionByName(updates.select(*base.columns))


def bucketed_upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``upsert`` onto a table bucketed by ``keys`` (see ``store_bucketed``), which is not shuffled.

    Only the updates move, to the buckets of the base.  Keys are unique on both
    sides, so there is no hot one that a join would have to split.
    """
    untouched = base.join(updates.select(*keys), list(keys), "left_anti")
    return untouched.select(*base.columns).unionByName(updates.select(*base.columns))


def densify(snapshot: DataFrame, wanted: DataFrame, keys: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """One row per wanted key; a key absent from the snapshot has zero amounts."""
    totals = snapshot.groupBy(*keys).agg(*[F.sum(a).try_cast(t).alias(a) for a, t in snapshot.dtypes if a in amounts])
    filled = [F.coalesce(F.col(a), F.lit(0)).cast(dict(totals.dtypes)[a]).alias(a) for a in amounts]
    return wanted.select(*keys).distinct().join(totals, list(keys), "left").select(*keys, *filled)


def compare_deliveries(a: DataFrame, b: DataFrame, variant: str, parent: str) -> DataFrame:
    """One row: rows, distinct variants and parents of two deliveries and what they share.

    Variants and parents are counted each by itself, so a variant may change
    its parent; a NULL is a row but neither a variant nor a parent.  Each row of
    the stacked deliveries gives one cell per level, which are aggregated by
    their value: nothing is joined.
    """
    tagged = a.select(variant, parent, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(variant, parent, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    levels = F.array(F.col(variant).cast("string"), F.col(parent).cast("string"))
    cells = tagged.select("in_a", "in_b", F.posexplode(levels).alias("level", "key"))
    per_key = cells.groupBy("level", "key").agg(F.sum("in_a").alias("rows_a"), F.sum("in_b").alias("rows_b"))
    in_a, in_b = F.col("rows_a") > 0, F.col("rows_b") > 0

    def counted(level: int, name: str) -> list[Column]:
        known = (F.col("level") == level) & F.col("key").isNotNull()
        sides = ((in_a, "a"), (in_b, "b"), (in_a & in_b, "common"))
        return [F.count_if(known & side).alias(f"{name}_{which}") for side, which in sides]

    # two empty deliveries have no rows to sum
    sums = {which: F.sum(F.when(F.col("level") == 0, F.col(f"rows_{which}"))) for which in "ab"}
    rows = [F.coalesce(total, F.lit(0).cast("long")).alias(f"rows_{which}") for which, total in sums.items()]
    return per_key.agg(*rows, *counted(0, "variants"), *counted(1, "parents"))
