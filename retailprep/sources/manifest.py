"""Checksums of delivered files."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .read import path_below

# Workers get what they run with the task and need this package from nowhere else.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the manifest format.
ALGORITHM = "SHA1"
MANIFEST = "manifest"


def checksum(content: Column | str) -> Column:
    return F.sha1(content)


# What the binaryFile source can hold in one row.
LONGEST_FILE = 2**31 - 1
GLOB = "{*.[cC][sS][vV],*manifest}"
BOM = "\ufeff".encode()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, checksum) of files whose lines follow each other, a line at a time.

    The reader takes line ends and a byte order mark away.  What the file had is
    told by its size: lines and the ends between them, or those and 1, 3 or 4 bytes more.
    """
    path, plain, marked, lines, size = None, None, None, 0, 0

    def checksum() -> pa.RecordBatch:
        rest = wanted - size
        digest = marked if rest >= len(BOM) else plain
        if rest % len(BOM):
            digest.update(b"\n")
        if rest not in (0, 1, len(BOM), len(BOM) + 1):
            raise ValueError(f"{path} has {wanted} bytes, {size} of which were read")
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()])], names=["path", "checksum"])

    for batch in batches:
        for name, length, line in zip(*[batch.column(c) for c in ("path", "size", "value")], strict=True):
            if name.as_py() != path:
                if path is not None:
                    yield checksum()
                path, wanted, lines, size = name.as_py(), length.as_py(), 0, 0
                plain, marked = hashlib.sha1(), hashlib.sha1(BOM)
            content = line.as_buffer()
            for digest in (plain, marked):
                if lines:
                    digest.update(b"\n")
                digest.update(content)
            size += len(content) + (lines > 0)
            lines += 1
    if path is not None:
        yield checksum()


def long_checksums(spark: SparkSession, folder: str, above: int) -> DataFrame:
    """(file, checksum) of the files with more than ``above`` bytes, each read as a stream by one task.

    A task holds a batch of lines, however long the file.  The reader's own
    session keeps files whole and one per task: no split is longer than the
    longest file, and opening one counts as much.
    """
    def files(session: SparkSession, kind: str, **options) -> DataFrame:
        found = session.read.format(kind).options(recursiveFileLookup=True, pathGlobFilter=GLOB, **options).load(folder)
        return found.filter(F.col("_metadata.file_size") > above)

    longest = files(spark, "binaryFile").agg(F.max("_metadata.file_size").alias("longest")).first()["longest"]
    whole = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        whole.conf.set(f"spark.sql.files.{name}", longest or above)
    # metadata paths are written like URLs
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = files(whole, "text", lineSep="\n").select(
        path.alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value")
    )
    sums = lines.mapInArrow(_streamed, "path string, checksum string")
    return sums.select(path_below(spark, folder).alias("file"), "checksum")


def file_manifest(spark: SparkSession, folder: str, longest: int = LONGEST_FILE) -> DataFrame:
    """(file, algorithm, checksum, bytes) of every CSV below ``folder``, names relative to it.

    Files are hashed where they are read: those of up to ``longest`` bytes as
    one row each, longer ones as a stream of lines (``long_checksums``).  A
    manifest at the top is left out, and Spark's sources do not show empty files.
    """
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=GLOB)
        .load(folder)
        .withColumn("file", path_below(spark, folder))
        .filter(F.col("file") != MANIFEST)
    )
    # The length comes from the listing and is pushed to the source: longer files are not opened here.
    found = files.filter(F.col("length") <= longest).select("file", checksum("content").alias("checksum"), "length")
    rest = files.filter(F.col("length") > longest).select("file", "length")
    if not rest.isEmpty():
        found = found.unionByName(rest.join(long_checksums(spark, folder, longest), "file").select(*found.columns))
    return found.select("file", F.lit(ALGORITHM).alias("algorithm"), "checksum", F.col("length").alias("bytes"))


def write_manifest(manifest: DataFrame, path: str, sep: str = " ") -> None:
    """Write the manifest as text lines sorted by file name."""
    line = F.concat_ws(sep, "file", "algorithm", "checksum").alias("value")
    manifest.orderBy("file").select(line).write.mode("overwrite").text(path)
