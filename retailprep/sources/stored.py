"""Dictionaries and histories kept in a layout that the daily work does not shuffle or rewrite."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.temporal import lowest_first, validity
from ..session import settle
from .read import optional


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Keep ``df`` as a table bucketed and sorted by ``keys``, one file per bucket, and read it.

    Joins and aggregations by the keys then use the buckets as they lie, so
    that a daily delta moves only its own rows.  ``buckets`` should be at least
    the session's shuffle partitions, else Spark may shuffle the table after
    all.  An older table of the name is replaced.
    """
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def publish_version(df: DataFrame, view: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store a new version of a bucketed table beside the old one, which ``df`` may read, and point ``view`` to it.

    Readers see the old version until the new one is whole; a failed job leaves it.
    """
    name = f"{view}_{uuid.uuid4().hex}"
    store_bucketed(df, name, keys, buckets, path)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {name}")
    return df.sparkSession.table(view)


def _part(buckets: int) -> str:
    # the number is part of the name, so that another one does not look into the wrong folders
    return f"part_of_{buckets}"


def write_history(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Keep a history (see ``accumulate``) in ``buckets`` folders by the hash of its keys."""
    part = _part(buckets)
    placed = df.withColumn(part, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", part).write.partitionBy(part).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_history(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The history with its folder column; raises if it was kept in another number of folders."""
    stored = spark.read.parquet(path)
    if _part(buckets) not in stored.columns:
        raise ValueError(f"{path} is not kept in {buckets} folders: {stored.columns}")
    return stored


def extend_history(
    spark: SparkSession,
    path: str,
    snapshot: DataFrame,
    keys: Sequence[str],
    start: str,
    value: str,
    carry: Sequence[str] = (),
    end: str = "end_date",
    buckets: int = 256,
) -> list[int]:
    """Take a snapshot into the history at ``path`` and return the folders that changed.

    Only keys of the snapshot get a new timeline; other rows of their folders
    are copied, and folders without such a key are neither read nor written.
    The changed folders are first written aside, then replaced; if the job
    fails, the old history stays, and running it again gives the same.  The
    first snapshot starts the history.  The lowest price of a key and day counts;
    a snapshot with many is better reduced by ``lowest_value`` before.
    """
    part = _part(buckets)
    columns = [*keys, start, value, *carry]
    new = settle(snapshot.select(*columns).withColumn(part, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
    # at most one number per folder reaches the driver; as literals they prune the others from the scan
    touched = sorted(r[part] for r in new.select(part).distinct().collect())
    ddl = ", ".join(f"`{name}` {dtype}" for name, dtype in new.dtypes) + f", `{end}` date"
    stored = optional(lambda: read_history(spark, path, buckets), ddl, spark).filter(F.col(part).isin(touched))
    # the stored rows of a key and those that come meet in one shuffle by the key
    both = stored.select(*columns, end, part, F.lit(False).alias("__new")).unionByName(
        new.select(*columns, F.lit(None).cast("date").alias(end), part, F.lit(True).alias("__new"))
    )
    placed = lowest_first(both, keys, start, value, carry, "__first")
    placed = placed.withColumn("__again", F.max("__new").over(Window.partitionBy(*keys)))
    lines = validity(placed.filter("__first OR NOT __again"), keys, start, "__end")
    ends = F.when(F.col("__again"), F.col("__end")).otherwise(F.col(end)).alias(end)
    changed = settle(lines.select(*columns, ends, part))
    changed.hint("rebalance", part).write.partitionBy(part).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return touched
