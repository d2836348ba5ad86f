"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join and rebalance partitions at run time; the plans of this
# package rely on it for hot keys.  Broadcasts stay Spark's own, size-checked choice.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Spark then deletes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Feeds shuffle a few parsed columns after map-side aggregation, about a tenth of
# what they read: a partition per 2 GB of input sorts some 200 MB.
INPUT_BYTES_PER_PARTITION = 2 * 1024**3


def scale_settings(input_bytes: int, split_bytes: int = 128 * 1024**2) -> dict[str, str]:
    """Shuffle partitions and split size for feeds that read this much.

    AQE merges small partitions and splits those of skewed joins, but it does
    not split the partitions of aggregations and windows: their number must
    suit the data from the start.  ``split_bytes`` is what a map task reads.
    """
    return {
        "spark.sql.shuffle.partitions": str(200 + input_bytes // INPUT_BYTES_PER_PARTITION),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }


def apply_settings(builder: SparkSession.Builder, input_bytes: int | None = None) -> SparkSession.Builder:
    """The package's settings, sized for ``input_bytes`` of the largest feed if given."""
    scaled = {} if input_bytes is None else scale_settings(input_bytes)
    for key, value in {**SETTINGS, **scaled}.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach.

    That is ``spark.checkpoint.dir``, else the checkpoint folder set on the
    context, else a folder in the warehouse, which a cluster shares as well.
    """
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/retailprep/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application settled; for the end of a job, when its results and reports have been read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read from there afterwards.

    For frames that feed several actions: it survives lost executors, and no
    action recomputes the plan.  What was shuffled for the write is freed with
    its end, as nothing reads it again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete what ``settle`` wrote for frames that nothing will read any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if f"/retailprep/{spark.sparkContext.applicationId}/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
