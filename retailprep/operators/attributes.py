"""Attributes, hierarchies and agreement between parents and children."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import path_code
from ..sources.read import find_column
from .enrich import lookup_join


def pivot_attributes(
    long: DataFrame,
    definitions: DataFrame,
    key: str,
    code: str,
    label: str,
    value: str,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key with a column per attribute label.

    Of several values for one key and attribute the smallest is taken.  Pass
    ``names`` to fix the columns; otherwise Spark runs a job to find them.
    """
    described = long.join(definitions.select(code, label).distinct(), code)
    grouped = described.groupBy(key)
    pivoted = grouped.pivot(label, list(names)) if names else grouped.pivot(label)
    return pivoted.agg(F.min(value))


def join_attributes(df: DataFrame, pivoted: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Left-join pivoted attributes (one row per key); a column the frame already has is not replaced.

    ``unique`` says that the frame has one row per key too, so no key can be hot
    and the attributes may stay where the pivot left them.
    """
    clashes = [c for c in pivoted.columns if c != key and find_column(df, c) is not None]
    lookup = pivoted.drop(*clashes)
    return df.join(lookup, key, "left") if unique else lookup_join(df, lookup, [key])


def hierarchy(
    df: DataFrame,
    levels: Sequence[Column],
    prefix: str = "category_level",
    null_token: str | None = None,
) -> DataFrame:
    """Add ``<prefix>N_name`` and ``<prefix>N_code`` per level; a code covers the path down to its level."""
    out = {}
    for i, level in enumerate(levels, start=1):
        out[f"{prefix}{i}_name"] = level
        out[f"{prefix}{i}_code"] = path_code(list(levels[:i]), null_token=null_token)
    return df.withColumns(out)


def group_members(df: DataFrame, groups: Sequence[str], member: str) -> DataFrame:
    """Distinct members per group, one row each: a large group stays spread over many tasks."""
    return df.dropna(subset=list(groups)).select(*groups, member).distinct()


def group_sizes(df: DataFrame, groups: Sequence[str], member: str, name: str = "members") -> DataFrame:
    """Number of distinct members per group."""
    return group_members(df, groups, member).groupBy(*groups).agg(F.count(member).alias(name))


def _tuples(df: DataFrame, parent: str, columns: Sequence[str]) -> DataFrame:
    # one row per distinct combination: a parent with very many children shrinks map-side
    known = df.filter(F.col(parent).isNotNull())
    return known.groupBy(parent, *columns).agg(F.count(F.lit(1)).alias("__children"))


def _votes(df: DataFrame, parent: str, columns: Sequence[str]) -> DataFrame:
    """(parent, index of the column, value, number of children) for non-NULL values."""
    texts = F.array(*[F.col(c).cast("string") for c in columns])
    cells = _tuples(df, parent, columns).select(parent, "__children", F.posexplode(texts).alias("__c", "__value"))
    return (
        cells.filter(F.col("__value").isNotNull())
        .groupBy(parent, "__c", "__value")
        .agg(F.sum("__children").alias("__children"))
    )


def find_conflicts(df: DataFrame, parent: str, columns: Sequence[str]) -> DataFrame:
    """Parents whose children disagree, with the number of distinct values per column."""
    votes = _votes(df, parent, columns)
    counts = [F.count_if(F.col("__c") == i).alias(f"n_{c}") for i, c in enumerate(columns)]
    disagree = F.greatest(*[F.col(f"n_{c}") for c in columns], F.lit(0)) > 1
    return votes.groupBy(parent).agg(*counts).filter(disagree)


def consensus(df: DataFrame, parent: str, columns: Sequence[str], as_tuple: bool = False) -> DataFrame:
    """Give all children of a parent the parent's most frequent values.

    Each column votes on its own, so a code and its name may come from different
    rows; ``as_tuple`` takes the most frequent row of values that is not all NULL
    as a whole, of equally frequent ones the one with fewer gaps.  Ties go to the
    smallest value.  As long as no parent in the whole frame disagrees,
    nothing changes; otherwise gaps are filled from the siblings too.
    """
    typed = dict(df.dtypes)
    if as_tuple:
        votes = _tuples(df, parent, columns)
        values = [F.col(c).alias(f"v{i}") for i, c in enumerate(columns)]
        # rows with more values first: an empty row of values is no opinion
        gaps = reduce(lambda x, y: x + y, [F.col(c).isNull().cast("int") for c in columns])
        rank = F.struct((gaps == len(columns)).alias("empty"), (-F.col("__children")).alias("n"), gaps.alias("gaps"), *values)
        best = votes.groupBy(parent).agg(
            F.min(rank).alias("__best"), *[F.count_distinct(c).alias(f"__n{i}") for i, c in enumerate(columns)]
        )
        disagree = F.greatest(*[F.col(f"__n{i}") for i in range(len(columns))], F.lit(0)) > 1
        conflict = best.agg(F.max(disagree).alias("any")).scalar()
        best = best.filter(conflict).select(parent, "__best")
        joined = lookup_join(df, best, [parent])
        picked = {
            c: F.when(F.col("__best").isNotNull() & ~F.col("__best.empty"), F.col(f"__best.v{i}")).otherwise(F.col(c))
            for i, c in enumerate(columns)
        }
        return joined.withColumns(picked).drop("__best")

    votes = _votes(df, parent, columns)
    rank = F.struct((-F.col("__children")).alias("n"), F.col("__value").alias("value"))
    best = votes.groupBy(parent).agg(
        *[F.min(F.when(F.col("__c") == i, rank))["value"].alias(f"__best{i}") for i in range(len(columns))]
    )
    # one value for the whole frame; counting over the same votes lets Spark reuse their shuffle
    per_cell = votes.groupBy(parent, "__c").agg(F.count("__value").alias("values"), F.sum("__children").alias("n"))
    conflict = per_cell.agg(F.max((F.col("values") > 1) & (F.col("n") > 0)).alias("any")).scalar()
    joined = lookup_join(df, best.filter(conflict), [parent])
    settled = {
        c: F.coalesce(F.col(f"__best{i}").try_cast(typed[c]), F.col(c)) for i, c in enumerate(columns)
    }
    return joined.withColumns(settled).drop(*[f"__best{i}" for i in range(len(columns))])

