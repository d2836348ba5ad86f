"""Reports on errors and product status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .enrich import keep_known, lookup_join


def error_trend(errors: DataFrame, code: str, key: str, day: str) -> DataFrame:
    """Errors per code and day: rows, keys, first-time keys, keys so far, keys seen for the last time.

    Rows are first reduced to one per code, key and day, so the windows below
    hold at most one row per calendar day.
    """
    daily = errors.groupBy(code, key, day).agg(F.count(F.lit(1)).alias("errors"))
    span = Window.partitionBy(code, key)
    marked = daily.select(
        code,
        day,
        "errors",
        (F.col(day) == F.min(day).over(span)).cast("int").alias("first"),
        (F.col(day) == F.max(day).over(span)).cast("int").alias("last"),
    )
    per_day = marked.groupBy(code, day).agg(
        F.sum("errors").alias("errors"),
        F.count(F.lit(1)).alias("keys"),
        F.sum("first").alias("new_keys"),
        F.sum("last").alias("last_seen_keys"),
    )
    so_far = Window.partitionBy(code).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return per_day.withColumn("keys_so_far", F.sum("new_keys").over(so_far))


def unresolved_keys(errors: DataFrame, code: str, key: str, day: str) -> DataFrame:
    """Keys still failing on their code's newest day, with the first and last day they failed."""
    spans = errors.groupBy(code, key).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    newest = spans.groupBy(code).agg(F.max("last_day").alias("newest"))
    return (
        lookup_join(spans, newest, [code], "inner")
        .filter(F.col("last_day") == F.col("newest"))
        .select(code, key, "first_day", "last_day")
    )


def inactive_parents(variants: DataFrame, parent: str, active: str) -> DataFrame:
    """Parents whose variants are all inactive, with the number of variants; a NULL flag is inactive."""
    on = F.coalesce(F.col(active), F.lit(0)) == 1
    return (
        variants.groupBy(parent)
        .agg(F.count(F.lit(1)).alias("variants"), F.max(on).alias("__any"))
        .filter(~F.col("__any"))
        .drop("__any")
    )


def inactive_variants(
    variants: DataFrame,
    parents: DataFrame,
    parent: str,
    variant: str,
    active: str,
    moving: DataFrame | None = None,
) -> DataFrame:
    """Inactive variants of active parents; with ``moving``, only those with stock in movement."""
    off = variants.filter(F.coalesce(F.col(active), F.lit(0)) != 1)
    out = keep_known(off, parents.filter(F.col(active) == 1), [parent])
    return out if moving is None else keep_known(out, moving, [variant])


def profile_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of the columns."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
