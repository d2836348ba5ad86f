"""Validity intervals and as-of lookups by day and by instant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import to_col


def lowest_value(
    df: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Lowest non-NULL ``value`` per key, with the ``carry`` columns of that row.

    An aggregation: each task sends one row per key, however many a key has.
    Equal values are settled by the smallest carried columns, NULLs last.
    """
    if not carry:
        return df.groupBy(*keys).agg(F.min(value).alias(value))
    ties = [x for c in carry for x in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]
    rank = F.struct(F.col(value).isNull().alias("__none"), F.col(value), *ties)
    best = df.groupBy(*keys).agg(F.min(rank).alias("__best"))
    return best.select(*keys, f"__best.{value}", *[f"__best.{c}" for c in carry])


def validity(df: DataFrame, keys: Sequence[str], start: str, end: str = "end_date") -> DataFrame:
    """Add the last valid day: the day before the next start, NULL for the newest row.

    Starts must be unique days per key (see ``lowest_value``), which also bounds
    a key to one row per calendar day.
    """
    window = Window.partitionBy(*keys).orderBy(start)
    return df.withColumn(end, F.date_sub(F.lead(start).over(window), 1))


def lowest_first(df: DataFrame, keys: Sequence[str], start: str, value: str, carry: Sequence[str], flag: str) -> DataFrame:
    """Add whether a row is the one that ``lowest_value`` takes of its key and day; in one shuffle by the keys.

    Rows come out sorted by key and day, so that windows over the keys and days
    that follow neither shuffle nor sort again.
    """
    ties = [F.col(c).asc_nulls_last() for c in (value, *carry)]
    window = Window.partitionBy(*keys).orderBy(start, *ties)
    placed = df.withColumns({"__before": F.lag(start).over(window), "__place": F.row_number().over(window)})
    first = (F.col("__place") == 1) | ~F.col("__before").eqNullSafe(F.col(start))
    return placed.withColumn(flag, first).drop("__before", "__place")


def timeline(df: DataFrame, keys: Sequence[str], start: str, value: str, carry: Sequence[str] = (), end: str = "end_date") -> DataFrame:
    """``validity`` of ``lowest_value`` in one shuffle and one sort.

    For rows of which a key has few per day, as after ``lowest_value`` of each
    of several snapshots; many of them are better aggregated before.
    """
    first = lowest_first(df, keys, start, value, carry, "__first").filter("__first").drop("__first")
    return validity(first, keys, start, end)


def asof_join(
    facts: DataFrame,
    quotes: DataFrame,
    by: Sequence[str],
    fact_day: str,
    quote_day: str,
    columns: Sequence[str],
) -> DataFrame:
    """Each fact with ``columns`` of the newest quote of its key on or before its day.

    ``quote_day`` comes along; all are NULL without such a quote.  Of several
    quotes on one day the smallest counts (lowest price first, NULL last); a
    NULL in the newest quote is not replaced by an older value.

    Facts are not windowed, and are read and shuffled once.  Quotes are: the lowest
    of a key and day is valid until the key's next one, so a key holds at most one
    row per calendar day however many quotes it has.  Facts then meet the rows of
    their key, of which at most one is valid on the day: the join cannot multiply
    them, AQE splits its hot keys, and it compares a fact with one row per quoted day of its key.
    """
    keys = list(by)
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, "__day")])
    dated = quotes.select(*keys, F.col(quote_day).cast("date").alias("__day"), *columns).filter(usable)
    best = lowest_value(dated, [*keys, "__day"], columns[0], columns[1:])
    line = Window.partitionBy(*keys).orderBy("__day")
    # Keys that come out of the window are new to Spark: it shuffles both sides for the join, which AQE then may split.
    valid = best.select(
        *[F.first(c).over(line.rowsBetween(Window.unboundedPreceding, 0)).alias(f"__key_{c}") for c in keys],
        F.col("__day").alias("__from"),
        F.lead("__day").over(line).alias("__until"),
        *[F.col(c).alias(f"__quoted_{c}") for c in columns],
    )
    asked = facts.withColumn("__day", F.col(fact_day).cast("date"))
    same = [F.col(c) == F.col(f"__key_{c}") for c in keys]
    then = (F.col("__day") >= F.col("__from")) & (F.col("__until").isNull() | (F.col("__day") < F.col("__until")))
    joined = asked.join(valid, reduce(lambda a, b: a & b, [*same, then]), "left")
    picked = [F.col("__from").alias(quote_day), *[F.col(f"__quoted_{c}").alias(c) for c in columns]]
    return joined.select(*[F.col(c) for c in facts.columns], *picked)


def asof_window(
    facts: DataFrame, quotes: DataFrame, by: Sequence[str], fact_day: str, quote_day: str, columns: Sequence[str]
) -> DataFrame:
    """``asof_join`` for facts of which a key has few per day: they are windowed themselves, in one shuffle.

    For distinct rows of key, day and columns with a bounded number of values;
    facts as such belong into ``asof_join``, which windows keys and days only.
    """
    keys = list(by)
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, "__day")])
    dated = quotes.select(*keys, F.col(quote_day).cast("date").alias("__day"), *columns).filter(usable)
    best = lowest_value(dated, [*keys, "__day"], columns[0], columns[1:])
    quote = F.struct(F.col("__day").alias(quote_day), *columns).alias("__quote")
    asked = facts.withColumns({"__day": F.col(fact_day).cast("date"), "__side": F.lit(1)})
    line = best.select(*keys, "__day", F.lit(0).alias("__side"), quote).unionByName(asked, allowMissingColumns=True)
    upto = Window.partitionBy(*keys).orderBy("__day", "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("__quote", F.last("__quote", ignorenulls=True).over(upto)).filter(F.col("__side") == 1)
    picked = [F.col(f"__quote.{c}").alias(c) for c in (quote_day, *columns)]
    return found.select(*[F.col(c) for c in facts.columns], *picked)


def asof_windows(
    facts: DataFrame, day: str, by: str, lists: Mapping[str, tuple[DataFrame, str, str]]
) -> DataFrame:
    """Facts with prices of several lists as of their ``day``, each by ``by`` and a column; in one shuffle by ``by``.

    ``lists`` gives for each price column its quotes, which hold it and ``by``, that other
    column and the date of the quote, and the names of the latter two.  The day is a date, or
    an instant, on which quotes of its date count.  All rows of a value of ``by`` meet in a
    task, as in ``asof_window``: for distinct rows with a bounded number of values.  Of several
    quotes on one day the lowest counts, NULL last; a NULL in the newest one stays.
    """
    line = facts.withColumn("__side", F.lit(1))
    for price, (quotes, column, quote_day) in lists.items():
        usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (by, column, day)])
        dated = quotes.select(by, column, F.col(quote_day).cast("date").alias(day), price).filter(usable)
        best = lowest_value(dated, [by, column, day], price)
        # a struct: a NULL inside it still makes it the newest quote
        best = best.select(by, column, day, F.lit(0).alias("__side"), F.struct(price).alias(f"__{price}"))
        line = line.unionByName(best, allowMissingColumns=True)
    line = line.repartition(by)
    for price, (_, column, _) in lists.items():
        upto = Window.partitionBy(by, column).orderBy(day, "__side").rowsBetween(Window.unboundedPreceding, 0)
        line = line.withColumn(f"__{price}", F.last(f"__{price}", ignorenulls=True).over(upto))
    found = line.filter(F.col("__side") == 1)
    return found.select(*[F.col(c) for c in facts.columns], *[F.col(f"__{price}.{price}").alias(price) for price in lists])


# Slices of the as-of join by instant: long enough to hold many rows of a usual key, short enough to cut a hot one.
SLICE_SECONDS = 3600


def asof_instant(
    facts: DataFrame,
    quotes: DataFrame,
    by: Sequence[str],
    fact_ts: str,
    quote_ts: str,
    columns: Sequence[str],
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Each fact with ``columns`` of the newest quote of its key at or before its instant.

    Like ``asof_join`` at the grain of microseconds: of several quotes at one
    instant the smallest counts, and a NULL in the newest quote stays.  Days
    count as their midnight.

    A key may have any number of instants, so its line is cut into slices of
    ``slice_seconds``: windows run within (key, slice), and what a slice does
    not have itself is carried over from the last slice before it that closed
    with a quote.  The carrying window sees one row per key and slice with rows,
    so no task holds more than a slice of a key, or the number of its slices.
    """
    if slice_seconds < 1:
        raise ValueError("a slice has a second at least")
    keys = list(by)
    sliced = [*keys, "__slice"]
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, "__ts")])
    number = F.expr(f"unix_micros(__ts) div {slice_seconds * 1_000_000}")
    asked = facts.select(*keys, F.col(fact_ts).cast("timestamp").alias("__ts")).filter(usable).distinct()
    timed = quotes.select(*keys, F.col(quote_ts).cast("timestamp").alias("__ts"), *columns).filter(usable)
    best = lowest_value(timed, [*keys, "__ts"], columns[0], columns[1:])
    quote = F.struct(F.col("__ts").alias(quote_ts), *columns)
    line = (
        asked.withColumns({"__side": F.lit(1), "__quote": F.lit(None)})
        .unionByName(best.select(*keys, "__ts", F.lit(0).alias("__side"), quote.alias("__quote")))
        .withColumn("__slice", number)
    )
    upto = Window.partitionBy(*sliced).orderBy("__ts", "__side").rowsBetween(Window.unboundedPreceding, 0)
    within = line.withColumn("__own", F.last("__quote", ignorenulls=True).over(upto)).filter(F.col("__side") == 1)
    closing = F.max_by("__quote", F.when(F.col("__side") == 0, F.col("__ts"))).alias("__closing")
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = line.groupBy(*sliced).agg(closing).select(*sliced, F.last("__closing", ignorenulls=True).over(earlier).alias("__carried"))
    found = within.join(carried, sliced, "left").select(*keys, "__ts", F.coalesce("__own", "__carried").alias("__quote"))
    joined = facts.withColumn("__ts", F.col(fact_ts).cast("timestamp")).join(found, [*keys, "__ts"], "left")
    picked = [F.col(f"__quote.{c}").alias(c) for c in (quote_ts, *columns)]
    return joined.select(*[F.col(c) for c in facts.columns], *picked)


def price_fallback(*prices: Column | str) -> Column:
    """The first price that is not NULL."""
    return F.coalesce(*[to_col(p) for p in prices])


def accumulate(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    start: str,
    value: str,
    carry: Sequence[str] = (),
    end: str = "end_date",
) -> DataFrame:
    """History and a new snapshot as one timeline: lowest value per key and day, then validity.

    Both should have few rows per key and day (see ``timeline``).
    """
    columns = [*keys, start, value, *carry]
    both = history.select(*columns).unionByName(snapshot.select(*columns))
    return timeline(both, keys, start, value, carry, end)
