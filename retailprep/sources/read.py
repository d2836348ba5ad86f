"""Reading delimited feeds and Parquet dictionaries."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import to_col

log = logging.getLogger(__name__)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Column names stripped, lower-cased and reduced to ASCII (drops a BOM)."""
    names = [c.encode("ascii", "ignore").decode().strip().lower() for c in df.columns]
    return df.toDF(*names)


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    trim: bool = False,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read headered delimited files with every column as text.

    With ``schema`` the declared columns are picked by name and typed with
    ``try_cast``: a bad value is NULL, not an error, and nothing is inferred.
    """
    raw = spark.read.options(
        header=True,
        sep=sep,
        encoding=encoding,
        ignoreLeadingWhiteSpace=trim,
        ignoreTrailingWhiteSpace=trim,
    ).csv(path)
    df = normalise_headers(raw)
    if schema is None:
        return df
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return df.select(*[column_or_null(df, f.name, f.dataType.simpleString()) for f in schema])


def resolved(spark: SparkSession, folder: str) -> str:
    """The folder as its file system names it: absolute, with its scheme, without ``..`` and double slashes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.globStatus(path) is None or len(system.globStatus(path)) != 1:
        raise FileNotFoundError(f"{folder} is not one folder")
    return system.globStatus(path)[0].getPath().toString()


def path_below(spark: SparkSession, folder: str, path: Column | str = "path") -> Column:
    """A file's path relative to ``folder``; a path outside it raises."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "", resolved(spark, folder)).rstrip("/") + "/"
    path = F.regexp_replace(to_col(path), r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")
    outside = F.raise_error(F.concat(path, F.lit(f" is not below {bare}")))
    return F.when(path.startswith(bare), F.substring(path, len(bare) + 1, F.length(path))).otherwise(outside)


def latest_path(spark: SparkSession, folder: str, prefix: str, suffix: str = ".csv") -> str:
    """Path of the alphabetically last ``prefix*suffix`` delivery, which for dated names is the newest.

    A delivery is a file or a folder of parts.  Only the listing is used: the
    content column is pruned, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    names = files.select(F.substring_index(path_below(spark, folder), "/", 1).alias("name"))
    matching = names.filter(F.col("name").startswith(prefix) & F.col("name").endswith(suffix))
    newest = matching.agg(F.max("name").alias("name")).first()["name"]
    if newest is None:
        raise FileNotFoundError(f"no {prefix}*{suffix} in {folder}")
    return f"{folder.rstrip('/')}/{newest}"


def read_latest(
    spark: SparkSession,
    folder: str,
    prefix: str,
    mode: str = "LATEST",
    name: str | None = None,
    **options,
) -> DataFrame:
    """Read the newest file of a folder (LATEST) or the named one (MANUAL)."""
    if mode == "LATEST":
        path = latest_path(spark, folder, prefix)
    elif mode == "MANUAL":
        if not name:
            raise ValueError("mode MANUAL needs a file name")
        path = f"{folder.rstrip('/')}/{name}"
    else:
        raise ValueError(f"unknown mode {mode!r}, expected LATEST or MANUAL")
    return read_feed(spark, path, **options)


# What a column is made of: the alternative names it has had, first come first, and its type.
Alternatives = Mapping[str, tuple[Sequence[str], str]]

# Footers read at a time; they are metadata, one per snapshot folder.
FOOTERS_AT_A_TIME = 16


def schema_groups(spark: SparkSession, path: str, by_file: bool = False) -> list[tuple[StructType, list[str]]]:
    """The schemas below ``path`` and the snapshot folders that have each, in the order of their names.

    A folder's files are taken to be one delivery, written by one job: the
    footer of one of them counts.  ``by_file`` looks at every file's own.  Paths
    come from a listing, no file is opened for them, and only footers are read;
    their number follows the number of snapshots, not of rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    unit = F.col("path") if by_file else F.regexp_replace("path", "/[^/]*$", "")
    units = sorted(r["unit"] for r in files.select(unit.alias("unit")).distinct().collect())
    if not units:
        # the source's own error, which ``optional`` knows
        spark.read.parquet(path)
    with ThreadPoolExecutor(FOOTERS_AT_A_TIME) as pool:
        schemas = list(pool.map(lambda unit: spark.read.parquet(unit).schema, units))
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for unit, schema in zip(units, schemas, strict=True):
        names = json.dumps(sorted((f.name, f.dataType.jsonValue()) for f in schema), default=str)
        groups.setdefault(names, (schema, []))[1].append(unit)
    return list(groups.values())


def read_dictionary(
    spark: SparkSession, path: str, columns: Alternatives | None = None, absent: str = "raise", by_file: bool = False
) -> DataFrame:
    """Read a Parquet dictionary over all its snapshot folders.

    With ``columns`` every snapshot is mapped by its own schema: a target takes
    the first of its alternative names that the snapshot has, cast to its type
    (a value that does not fit is NULL), and the snapshots are stacked.  A
    target without any of its names in some snapshot raises, or is NULL there
    with ``absent="null"``.  Snapshots of one schema are one scan, which reads
    the mapped columns only.  Without ``columns`` the files must share a schema.

    The same key may come once per snapshot; take ``distinct_keys`` or
    ``latest_by`` before joining.
    """
    if absent not in ("raise", "null"):
        raise ValueError(f"unknown choice {absent!r}, expected raise or null")
    if columns is None:
        return spark.read.option("recursiveFileLookup", "true").parquet(path)
    parts = []
    for schema, units in schema_groups(spark, path, by_file):
        part = spark.read.schema(schema).parquet(*units)
        picked = []
        for target, (names, dtype) in columns.items():
            found = find_column(part, *names)
            if found is None and absent == "raise":
                raise MissingNames(f"{target}: none of {list(names)} in {units[0]}, which has {sorted(part.columns)}")
            value = F.lit(None) if found is None else F.col(f"`{found}`")
            picked.append(value.try_cast(dtype).alias(target))
        parts.append(part.select(*picked))
    return reduce(DataFrame.unionByName, parts)


class MissingNames(ValueError):
    """A snapshot has a column under none of its known names."""


# Spark's names for a source that is not there or holds no file yet.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def optional(read: Callable[[], DataFrame], schema: StructType | str, spark: SparkSession) -> DataFrame:
    """Result of ``read``, or a typed empty frame when the source does not exist.

    Only a missing path and a folder without files count as absent; a wrong
    column or type raises.
    """
    try:
        return read()
    except FileNotFoundError as error:
        reason = str(error)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith(ABSENT):
            raise
        reason = str(error)
    log.warning("optional source skipped: %s", reason.splitlines()[0])
    return spark.createDataFrame([], schema)


def find_column(df: DataFrame, *names: str) -> str | None:
    """The first of ``names`` the frame has, in the frame's own spelling."""
    own = {c.lower(): c for c in df.columns}
    return next((own[n.lower()] for n in names if n.lower() in own), None)


def first_column(df: DataFrame, *names: str) -> Column:
    """The first of several alternative columns the frame has."""
    found = find_column(df, *names)
    if found is None:
        raise ValueError(f"none of {list(names)} in {sorted(df.columns)}")
    return F.col(f"`{found}`")


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column as ``dtype``, or typed NULLs when the frame does not have it."""
    found = find_column(df, name)
    value = F.lit(None) if found is None else F.col(f"`{found}`")
    return value.try_cast(dtype).alias(name)


def with_columns_or_null(df: DataFrame, names: Sequence[str], dtype: str = "string") -> DataFrame:
    """The frame with every absent one of ``names`` added as typed NULLs."""
    absent = [n for n in names if find_column(df, n) is None]
    return df.select("*", *[F.lit(None).cast(dtype).alias(n) for n in absent])
