"""Data-quality checks as report tables.

All checks of a feed are counted in one aggregation and come back as rows;
nothing is counted twice and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import is_blank

INFO, WARN, CRITICAL = "INFO", "WARN", "CRITICAL"


class EmptyFeed(ValueError):
    """A feed that must have rows has none."""


def check_not_empty(df: DataFrame, label: str = "feed") -> DataFrame:
    """The frame itself, or ``EmptyFeed``; reads until the first row."""
    if df.isEmpty():
        raise EmptyFeed(f"{label}: no rows")
    return df


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all neither NULL nor blank."""
    kept = df
    for key in keys:
        kept = kept.filter(~is_blank(key))
    return kept


@dataclass(frozen=True)
class Check:
    """Rows matching ``condition`` are counted; ``column`` and ``level`` label them."""

    name: str
    column: str
    level: str
    condition: Column


def blank_check(column: str, level: str = WARN) -> Check:
    return Check("blank", column, level, is_blank(column))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with three digits, rounded half up; NULL of nothing."""
    exact = F.try_divide((part * 100).cast("decimal(20,0)"), whole.cast("decimal(20,0)"))
    return F.round(exact, 3).cast("decimal(7,3)")


@dataclass(frozen=True)
class Report:
    """Aggregates that can be taken of a frame, by name, and the rows made of their one line."""

    aggregates: Mapping[str, Column]
    rows: Callable[[DataFrame], DataFrame]

    def of(self, df: DataFrame) -> DataFrame:
        """The report of a frame, in one aggregation."""
        return self.rows(df.agg(*[value.alias(name) for name, value in self.aggregates.items()]))

    def observed(self, df: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
        """The frame, which counts its rows while it is first written, and its report.

        The report is asked for after that action and reads nothing again.  Put
        it where no shuffle follows before the write (a feed's last step, or
        what is settled): there every task counts once, also when executors are
        lost, while the tasks before a shuffle may be run and counted anew.
        """
        seen = Observation()
        spark = df.sparkSession
        counted = df.observe(seen, *[value.alias(name) for name, value in self.aggregates.items()])

        def report() -> DataFrame:
            counts = seen.get
            schema = ", ".join(f"{name} long" for name in self.aggregates)
            return self.rows(spark.createDataFrame([tuple(counts[name] for name in self.aggregates)], schema))

        return counted, report


def _as_rows(counts: DataFrame, structs: list[Column]) -> DataFrame:
    return counts.select(F.inline(F.array(*structs)))


def quality_counts(checks: Sequence[Check]) -> Report:
    """(check, column, level, rows, share) per check, after one ``rows`` line for the total.

    ``share`` is the part of all rows in percent, NULL for an empty feed, whose
    total line is CRITICAL.
    """

    def line(name: str, column: str, level: Column, rows: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(column).alias("column"),
            level.alias("level"),
            rows.alias("rows"),
            percent(rows, F.col("total")).alias("share"),
        )

    def rows(counts: DataFrame) -> DataFrame:
        total_level = F.when(F.col("total") == 0, F.lit(CRITICAL)).otherwise(F.lit(INFO))
        lines = [line("rows", "*", total_level, F.col("total"))]
        for i, check in enumerate(checks):
            hit = F.col(f"c{i}")
            level = F.when(hit > 0, F.lit(check.level)).otherwise(F.lit(INFO))
            lines.append(line(check.name, check.column, level, hit))
        return _as_rows(counts, lines)

    return Report({"total": F.count(F.lit(1))} | {f"c{i}": F.count_if(c.condition) for i, c in enumerate(checks)}, rows)


def quality_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """See ``quality_counts``."""
    return quality_counts(checks).of(df)


def null_counts(columns: Sequence[str]) -> Report:
    """(column, rows, blanks, share) for each column: NULL or empty values."""

    def rows(counts: DataFrame) -> DataFrame:
        total = F.col("total")
        return _as_rows(
            counts,
            [
                F.struct(
                    F.lit(c).alias("column"),
                    total.alias("rows"),
                    F.col(f"c{i}").alias("blanks"),
                    percent(F.col(f"c{i}"), total).alias("share"),
                )
                for i, c in enumerate(columns)
            ],
        )

    blank = {f"c{i}": F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")) for i, c in enumerate(columns)}
    return Report({"total": F.count(F.lit(1))} | blank, rows)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """See ``null_counts``."""
    return null_counts(columns).of(df)


def audit_outcome(reasons: Mapping[str, Column]) -> Column:
    """Name of the first reason that holds for a row, ``kept`` when none does."""
    out = F.lit("kept")
    for name, condition in reversed(reasons.items()):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def volume_counts(reasons: Mapping[str, Column]) -> Report:
    """(outcome, rows): total, rows dropped per reason in order, rows kept."""
    names = [*reasons, "kept"]

    def rows(counts: DataFrame) -> DataFrame:
        lines = [F.struct(F.lit("total").alias("outcome"), F.col("total").alias("rows"))]
        lines += [F.struct(F.lit(n).alias("outcome"), F.col(f"c{i}").alias("rows")) for i, n in enumerate(names)]
        return _as_rows(counts, lines)

    outcome = audit_outcome(reasons)
    return Report({"total": F.count(F.lit(1))} | {f"c{i}": F.count_if(outcome == n) for i, n in enumerate(names)}, rows)


def volume_audit(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """See ``volume_counts``."""
    return volume_counts(reasons).of(df)


def audited(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows no reason drops, and their volume audit, counted while they are written."""
    counted, report = volume_counts(reasons).observed(df)
    return counted.filter(audit_outcome(reasons) == "kept"), report


def value_counts(df: DataFrame, *columns: str, name: str = "rows") -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), *[F.col(c).asc_nulls_last() for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that come more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def match_rate(df: DataFrame, column: str) -> DataFrame:
    """One row: all rows, rows with a value in ``column``, share in percent."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(column)).alias("matched"))
    return counts.withColumn("share", percent(F.col("matched"), F.col("rows")))


def store_stats(stores: DataFrame, country: str, active: str, closed: str, online: str) -> DataFrame:
    """One row: all stores, active and closed ones among the physical, online ones.

    A count of flags that are NULL throughout is NULL.
    """
    physical = F.col(country) != online

    def flagged(flag: str) -> Column:
        return F.sum(F.when(F.col(flag).isNotNull(), F.when(physical & (F.col(flag) == 1), 1).otherwise(0)))

    return stores.agg(
        F.count(F.lit(1)).alias("total"),
        flagged(active).alias("active"),
        flagged(closed).alias("closed"),
        F.count_if(F.col(country) == online).alias("online"),
    )
