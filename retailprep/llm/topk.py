"""Exact top-k search by inner product: exhaustive accumulation, term at a time, block against block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import settle
from .vectors import matrices

K = 20
# Rows of a block: 64 components of two bytes make 1 MB of candidates, or 128 kB of queries.
CANDIDATE_ROWS = 8192
QUERY_ROWS = 1024
LONGEST = np.iinfo(np.int64)


def whole(matrix: np.ndarray, factor: float) -> np.ndarray:
    """floor(factor * x) of finite doubles; past the range of longs as the nearest long."""
    with np.errstate(over="ignore"):
        product = np.floor(matrix.astype(np.float64) * factor)
    low, high = float(LONGEST.min), float(LONGEST.max)
    clipped = np.clip(product, low, np.nextafter(high, 0)).astype(np.int64)
    return np.where(product >= high, LONGEST.max, clipped)


def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, vec_id, is_query, dim, weights): the whole numbers of a vector in the fewest bytes."""
    for batch in batches:
        vec_id = batch.column("vec_id").to_pylist()
        number = batch.column("row").to_pylist()
        factor = batch.column("factor")[0].as_py() if batch.num_rows else 1.0
        asked = batch.column("is_query").to_pylist()
        out = []
        for rows, matrix in matrices(batch.column("vector")):
            good = np.isfinite(matrix).all(axis=1)
            rows, values = rows[good], whole(matrix[good], factor)
            for i, value in zip(rows.tolist(), values, strict=True):
                out.append((number[i], vec_id[i], asked[i], value))
        if out:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.int64()),
                    pa.array([x[2] for x in out], pa.bool_()),
                    pa.array([packed(x[3]) for x in out], pa.binary()),
                ],
                names=["row", "vec_id", "is_query", "weights"],
            )


def packed(value: np.ndarray) -> bytes:
    most = int(np.abs(value.astype(object)).max()) if len(value) else 0
    kind = next(k for k in "bhiq" if most <= np.iinfo(np.dtype(k)).max or k == "q")
    return kind.encode() + value.astype(np.dtype(kind)).tobytes()


def unpacked(blobs: list[bytes]) -> np.ndarray:
    """Rows of whole numbers; shorter vectors are filled up with zeros, which add nothing to a score."""
    rows = [np.frombuffer(b, np.dtype(chr(b[0])), offset=1) for b in blobs]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def block_best(queries: np.ndarray, candidates: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The k + 1 best candidates of each query and their scores, in no order; ties to earlier rows.

    The candidates are turned into one list of (row, weight) postings per term.
    Each term of a query scatters its weighted postings into a dense array of
    scores; a term that most rows hold keeps its postings as a full column.
    One more than k, as a query may meet its own row.
    """
    n, terms = candidates.shape
    most = int(np.abs(queries.astype(object)).max(initial=0)) * int(np.abs(candidates.astype(object)).max(initial=0)) * max(1, terms)
    kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
    lists = []
    for t in range(terms):
        rows = np.flatnonzero(candidates[:, t])
        full = 4 * len(rows) >= n
        weights = candidates[:, t] if full else candidates[rows, t]
        lists.append((slice(None) if full else rows, np.ascontiguousarray(weights).astype(kind)))
    scores, product = np.zeros(n, kind), np.zeros(n, kind)
    for query in queries:
        scores[:] = 0
        for t in np.flatnonzero(query).tolist():
            rows, weights = lists[t]
            if kind is object:
                scores[rows] += weights * int(query[t])
            else:
                part = np.multiply(weights, kind(query[t]), out=product[: len(weights)])
                scores[rows] += part
        total = np.clip(scores, LONGEST.min, LONGEST.max).astype(np.int64) if kind is object else scores
        take = min(k + 1, n)
        if take < n:
            least = np.partition(total, n - take)[n - take]
            over = np.flatnonzero(total > least)
            best = np.concatenate((over, np.flatnonzero(total == least)[: take - len(over)]))
        else:
            best = np.arange(n)
        yield best, total[best].astype(np.int64)


def searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                asked, there = pair["queries"], sorted(pair["candidates"], key=lambda c: (c["vec_id"] is None, c["vec_id"] or 0, c["row"]))
                left, right = unpacked([q["weights"] for q in asked]), unpacked([c["weights"] for c in there])
                width = max(left.shape[1], right.shape[1])
                left, right = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (left, right))
                ids = pa.array([c["vec_id"] for c in there], pa.int64())
                rows = np.array([c["row"] for c in there])
                for query, (best, scores) in zip(asked, block_best(left, right, k), strict=True):
                    other = rows[best] != query["row"]
                    best, scores = best[other], scores[other]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(best), query["row"])),
                            pa.array([query["vec_id"]] * len(best), pa.int64()),
                            ids.take(pa.array(best)),
                            pa.array(rows[best]),
                            pa.array(scores),
                        ],
                        names=["query_row", "query_id", "vec_id", "row", "score"],
                    )

    return run


def blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """(``name``_block, ``name``) of rows in blocks of about ``size``, and the number of blocks.

    Rows are dealt by their hash, so blocks differ in size by chance only.
    """
    count = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias(f"{name}_block")
    packed_rows = rows.groupBy(block).agg(F.collect_list(F.struct("row", "vec_id", "weights")).alias(name))
    return packed_rows, count


def top_inner_products(
    vectors: DataFrame,
    k: int = K,
    every: int = 20,
    factor: float = 64.0,
    query_rows: int = QUERY_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row whose id ``every`` divides.

    Scores are inner products of floor(factor * x); equal scores rank by the
    smaller vec_id, null ids last.  Queries and candidates are dealt to blocks
    of bounded size, every block of queries meets every block of candidates
    once, and each pair of blocks gives k rows per query at most, which a
    window ranks.

    Null vectors and those that hold null or non-finite components take no
    part; empty and zero vectors score 0 with every other.  Vectors of
    different lengths meet in the components both have.  Numbers and scores
    past the range of a long are the nearest long.  Repeated rows are candidates of each other, even
    if they share an id; rows with a null id are candidates but not queries.
    Fewer than k others give all of them; an empty table gives no rows.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.coalesce(F.col("vec_id") % every == 0, F.lit(False)).alias("is_query"),
        F.col("embedding").alias("vector"),
        F.lit(float(factor)).alias("factor"),
    )
    rows = settle(rows.mapInArrow(postings, "row long, vec_id long, is_query boolean, weights binary"))
    queries, n_queries = blocks(rows.where("is_query"), query_rows, "queries")
    candidates, n_candidates = blocks(rows, candidate_rows, "candidates")
    # A few rows, each a block: written once, then read for each block it meets.
    queries, candidates = settle(queries), settle(candidates)
    of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    pairs = queries.withColumn("candidates_block", of(n_candidates)).join(
        candidates.withColumn("queries_block", of(n_queries)).hint("shuffle_hash"), ["queries_block", "candidates_block"]
    )
    found = pairs.select("queries", "candidates").repartition(n_queries * n_candidates).mapInArrow(
        searched(k), "query_row long, query_id long, vec_id long, row long, score long"
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
