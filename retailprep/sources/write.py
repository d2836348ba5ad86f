"""Publishing feeds as delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import sample_head, sample_per_group
from ..session import settle

# Rows of a part; keeps files far below the 2 GB that a manifest can read.
PART_ROWS = 5_000_000

OPTIONS = {
    "header": True,
    "sep": ";",
    "encoding": "UTF-8",
    "quoteAll": False,
    "emptyValue": "",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_feed(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] = (),
    partition_by: str | None = None,
    null_as: str = "",
    part_rows: int = PART_ROWS,
    replace: str = "ALL",
    **options,
) -> None:
    """Write a feed: ``;``, header, UTF-8, ``null_as`` (empty text) for NULL.

    The result is a directory of parts of up to ``part_rows`` rows that replaces
    an older one.
    ``order_by`` gives a global order across the parts; end it in a unique
    column so that a value with many rows still spreads over several parts.
    ``partition_by`` puts each value (a price list) into its own folder in one
    job; the rebalance splits a large list over several tasks and keeps a small
    one in one.  ``replace="LISTS"`` then replaces the folders of the lists that
    come and leaves all others; until the job is committed, and if it fails,
    the old folders stay as they are.
    """
    if partition_by and order_by:
        raise ValueError("partition_by excludes order_by")
    if replace not in ("ALL", "LISTS") or (replace == "LISTS" and not partition_by):
        raise ValueError(f"cannot replace {replace!r}: expected ALL, or LISTS of a feed with partition_by")
    if order_by:
        df = df.orderBy(*order_by)
    if partition_by:
        folder = f"{partition_by}_key"
        df = df.withColumn(folder, F.col(partition_by)).hint("rebalance", folder)
        # the write's own setting, whatever the session has
        dynamic = "dynamic" if replace == "LISTS" else "static"
        writer = df.write.partitionBy(folder).option("partitionOverwriteMode", dynamic)
    else:
        writer = df.write
    writer.mode("overwrite").options(**{**OPTIONS, "maxRecordsPerFile": part_rows, "nullValue": null_as, **options}).csv(path)


def check_outputs(full_path: str | None, sample_path: str | None, mode: str) -> None:
    """Raise if the mode is unknown, lacks a folder, or its folders overlap; before any work is done."""
    if mode not in ("FULL", "TEST", "BOTH"):
        raise ValueError(f"unknown mode {mode!r}, expected FULL, TEST or BOTH")
    wanted = {"full": full_path if mode != "TEST" else "-", "sample": sample_path if mode != "FULL" else "-"}
    lacking = [name for name, path in wanted.items() if not path]
    if lacking:
        raise ValueError(f"mode {mode} needs a folder for {' and '.join(lacking)}")
    if mode == "BOTH":
        a, b = (p.rstrip("/") + "/" for p in (full_path, sample_path))
        if a.startswith(b) or b.startswith(a):
            raise ValueError("full and sample folders overlap")


def publish(
    df: DataFrame,
    full_path: str | None,
    sample_path: str | None,
    mode: str = "FULL",
    sample_order: Sequence[str] = (),
    sample_n: int = 1000,
    sample_by: str | None = None,
    settled: bool = False,
    **options,
) -> None:
    """Write the whole feed (FULL), a sample of it (TEST) or both (BOTH).

    The sample is the first ``sample_n`` rows by ``sample_order``, or that many
    per value of ``sample_by``.  Full and sample folders must not contain each
    other, since both are replaced as a whole.  BOTH writes the feed to the
    shared folder once and reads it from there, unless it is ``settled`` already.
    """
    check_outputs(full_path, sample_path, mode)
    if mode == "BOTH":
        df = df if settled else settle(df)
    if mode in ("FULL", "BOTH"):
        write_feed(df, full_path, **options)
    if mode in ("TEST", "BOTH"):
        if sample_by:
            sample = sample_per_group(df, [sample_by], sample_n, list(sample_order) or df.columns)
            write_feed(sample, sample_path, **options)
        else:
            sample = sample_head(df, sample_n, list(sample_order) or df.columns)
            options = {k: v for k, v in options.items() if k != "partition_by"}
            write_feed(sample, sample_path, **options)
