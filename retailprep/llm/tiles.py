"""Deal rows to tiles of bounded size so that all rows of a key meet, pair of tiles by pair of tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import looked_up


def dealt(placed: DataFrame, row: str, tile_rows: int) -> DataFrame:
    """``placed`` (key, row, ...) with (tile_a, tile_b, own): rows to compare have all but own in common.

    A key with up to ``tile_rows`` rows is one tile; a larger one is cut into
    tiles by the hash of the row, and every pair of its tiles meets in a place
    of its own.  Keys with a single row go.
    """
    sizes = placed.groupBy("key").agg(F.count("*").alias("__n")).where("__n > 1")
    tiles = F.ceil(F.col("__n") / tile_rows)
    out = looked_up(placed, sizes, "key").withColumn("__tiles", tiles)
    out = out.withColumn("own", F.pmod(F.xxhash64(row, F.lit(1)), F.col("__tiles")).cast("int"))
    out = out.withColumn("__other", F.explode(F.sequence(F.lit(0), (F.col("__tiles") - 1).cast("int"))))
    out = out.withColumn("tile_a", F.least("own", "__other")).withColumn("tile_b", F.greatest("own", "__other"))
    return out.drop("__n", "__tiles", "__other")


def met(tiled: DataFrame, compare: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Call ``compare(rows, starts)`` on whole groups of (key, tile_a, tile_b), several at a time.

    ``starts`` are the first rows of the groups and the number of rows.
    """
    place = ["key", "tile_a", "tile_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in place]
            now = tuple(c[-1] for c in columns)
            if held and all(c[0] == v for c, v in zip(columns, last, strict=True)) and now == last:
                held.append(batch)
                continue
            # The last group of a batch may go on in the next one.
            same = np.logical_and.reduce([c == v for c, v in zip(columns, now, strict=True)])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            done = pa.Table.from_batches([*held, batch.slice(0, cut)]) if held or cut else None
            if done is not None and done.num_rows:
                out = compare(done, starts_of(done, place))
                if out is not None:
                    yield out
            held, last = [batch.slice(cut)], now
        if held:
            done = pa.Table.from_batches(held)
            out = compare(done, starts_of(done, place))
            if out is not None:
                yield out

    return tiled.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, schema)


def starts_of(rows: pa.Table, place: list[str]) -> np.ndarray:
    columns = [rows.column(c).to_numpy() for c in place]
    new = np.ones(rows.num_rows, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(new), rows.num_rows)


def small_and_large(starts: np.ndarray, most: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The group of every row, and the groups of more than ``most`` rows as ranges."""
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, [(int(starts[k]), int(starts[k + 1])) for k in np.flatnonzero(sizes > most)]


def neighbours(group: np.ndarray, large: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same group, leaving out large groups, at one distance after another."""
    free = np.ones(len(group), bool)
    for a, b in large:
        free[a:b] = False
    rows = np.flatnonzero(free)
    group = group[rows]
    i = np.arange(len(rows))
    step = 1
    while len(i):
        i = i[i + step < len(rows)]
        i = i[group[i] == group[i + step]]
        if len(i):
            yield rows[i], rows[i + step]
        step += 1
