"""Connected components of links, by joins and aggregations only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle


def looked_up(df: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join with a table of one row per key so that a hot key can be split.

    The hash of the key is a second join column.  ``lookup`` comes out of an
    aggregation by the key alone, and with the pair Spark shuffles it again for
    the join; only such shuffles are split by AQE.
    """
    tag = "__key_hash"
    return df.withColumn(tag, F.xxhash64(key)).join(lookup.withColumn(tag, F.xxhash64(key)), [key, tag], how).drop(tag)


def _state(edges: DataFrame) -> tuple:
    marks: list[Column] = [F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)]
    return tuple(edges.agg(*marks).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is its smallest node.

    Alternates the two star steps until nothing changes: first the larger
    neighbours of every node are linked to the smallest node around it, then
    the smaller ones.  Both shrink to a join with an aggregate, rounds grow
    with the logarithm of the longest path, and the links of each round are
    written to the shared folder, so lost executors cost no more than a round.
    Repeated links, links both ways and links of a node to itself are allowed,
    those with a null end are left out; no links give no rows.
    """
    links = edges.where("a is not null and b is not null and a <> b")
    links = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    while state[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = looked_up(both.where("b > a"), around, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = looked_up(large, below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = settle(small.union(below.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select("b", "b").distinct()
    )


class Forest:
    """Which rows of a tile hang together; keeps links as a forest, never as pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Merge the sets of rows i[k] and j[k]."""
        label = self.label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            # Each set takes the smallest set it meets; sets met so are merged at once.
            low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            to = np.arange(len(label))
            np.minimum.at(to, high, low)
            label[:] = to[label]
            while True:
                further = to[label]
                if (further == label).all():
                    break
                label[:] = further

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """A link from each row that is not the first of its set to that one."""
        rows = np.flatnonzero(self.label != np.arange(len(self.label)))
        return rows, self.label[rows]
