"""Linear models over hashed n-gram indicators scaled by naive Bayes log-count ratios.

Both classifiers of this package are trained alike: the class counts of all
features come from every labelled document; the weights are then fitted by
dual coordinate descent on a bounded sample of the labelled documents, held as
lists of feature numbers.  Scoring is one pass without a shuffle.

A document is the set of its n-grams, each with the log-count ratio of its
class counts as value, scaled to length one.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .text import grouped

Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Settings:
    """``bits``: features are hashed to 2**bits numbers, which bounds the model.

    ``fit_rows``: expected size of the sample that the weights are fitted on.
    ``fit_features``: rows of the sample are used until they hold so many features.
    ``smoothing`` and ``sigmas``: see ``ratios``.
    ``cost``: the penalty of an error; that of the rarer class is raised so that
    both classes weigh the same.  ``squared``: squared hinge loss.
    """

    bits: int = 18
    fit_rows: int = 8192
    fit_features: int = 24_000_000
    smoothing: float = 1.0
    sigmas: float = 3.0
    cost: float = 1.0
    squared: bool = False
    epochs: int = 12


def ratios(counts: np.ndarray, smoothing: float, sigmas: float) -> np.ndarray:
    """Log of the smoothed share of each feature in class 1 against class 0; counts: 2 x features.

    A ratio within ``sigmas`` standard errors of zero is zero: the many rare
    n-grams of long documents would drown the few that tell.
    """
    known = counts + smoothing
    share = known / known.sum(axis=1, keepdims=True)
    ratio = np.log(share[1]) - np.log(share[0])
    return np.where(np.abs(ratio) >= sigmas * np.sqrt((1 / known).sum(axis=0)), ratio, 0.0)


def fit(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias of a hinge-loss model, by dual coordinate descent.

    Each step solves the dual problem of one document exactly and keeps the
    weights in step; rows are visited in another fixed order in every epoch.
    """
    weights, bias = np.zeros(len(scale)), 0.0
    n = len(rows)
    sign = np.where(labels == 1, 1.0, -1.0)
    ones = max(1, int((sign > 0).sum()))
    limit = np.where(sign > 0, n / (2 * ones), n / (2 * max(1, n - ones))) * settings.cost
    slack = 1 / (2 * limit) if settings.squared else np.zeros(n)
    bound = np.full(n, np.inf) if settings.squared else limit
    values = []
    for row in rows:
        x = scale[row]
        size = np.sqrt(x @ x)
        values.append((x / size if size > 0 else x).astype(np.float32))
    norm = np.array([float(x @ x) + 1.0 for x in values]) + slack
    dual = np.zeros(n)
    order = np.random.default_rng(7)
    for _ in range(settings.epochs):
        most = 0.0
        for i in order.permutation(n):
            row, x = rows[i], values[i]
            slope = sign[i] * (float(weights[row] @ x) + bias) - 1 + dual[i] * slack[i]
            new = min(max(dual[i] - slope / norm[i], 0.0), bound[i])
            step = (new - dual[i]) * sign[i]
            if step:
                weights[row] += step * x
                bias += step
                most = max(most, abs(step))
                dual[i] = new
        if most < 1e-3:
            break
    return weights, bias


def held_out(doc_id, folds: int, fold: int):
    """True for rows whose crc32 of the id as text leaves ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def one_label_a_document(labels: DataFrame, target: str) -> DataFrame:
    """(doc_id, label) of documents labelled 0 or 1 without contradiction."""
    return (
        labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(target).cast("int").alias("label"), F.max(target).cast("int").alias("__other"))
        .where("label = __other")
        .drop("__other")
    )


def collected(features: Features, size: int, keep: float):
    """Per task: the class counts of every feature, and the features of sampled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int64)
        seen = np.zeros(2, np.int64)
        for batch in batches:
            label = np.asarray(batch.column("label").to_numpy(zero_copy_only=False))
            draw = batch.column("draw").to_numpy(zero_copy_only=False)
            out: list[tuple[int, float, bytes]] = []
            for first, last, rows, found in grouped(batch.column("text"), features):
                of = label[first:last][rows]
                for k in (0, 1):
                    seen[k] += int((label[first:last] == k).sum())
                    counts[k] += np.bincount(found[of == k], minlength=size)
                cut = np.searchsorted(rows, np.arange(last - first + 1))
                for i in np.flatnonzero(draw[first:last] < keep):
                    row = found[cut[i] : cut[i + 1]].astype(np.uint32)
                    out.append((int(label[first + i]), float(draw[first + i]), zlib.compress(row.tobytes(), 1)))
            if out:
                kind, where, blob = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind, pa.int32()), pa.array(where, pa.float64()), pa.array(blob, pa.binary()), pa.nulls(len(out), pa.binary())],
                    names=["label", "draw", "row", "counts"],
                )
        if seen.sum():
            # One row a task, in pages, so that sums are spread over the cluster.
            for k in (0, 1):
                pages = counts[k].reshape(-1, min(size, 4096))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k] * len(pages), pa.int32()),
                        pa.array(range(len(pages)), pa.float64()),
                        pa.nulls(len(pages), pa.binary()),
                        pa.array([page.astype(np.int64).tobytes() for page in pages], pa.binary()),
                    ],
                    names=["label", "draw", "row", "counts"],
                )

    return run


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the pages of counts that meet in a task, page by page."""
    total: dict[tuple[int, float], np.ndarray] = {}
    for batch in batches:
        for label, page, blob in zip(*(batch.column(c).to_pylist() for c in ("label", "draw", "counts")), strict=True):
            part = np.frombuffer(blob, np.int64)
            key = (label, page)
            total[key] = total[key] + part if key in total else part
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.float64()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            names=["label", "draw", "counts"],
        )


@dataclass
class Model:
    """score = sigmoid(2 * (weights . x / |x| + bias)), the values of x being ``scale``."""

    scale: np.ndarray
    weights: np.ndarray
    bias: float
    constant: float | None = None


def train(texts: DataFrame, features: Features, settings: Settings) -> Model:
    """Fit a model to (text, label, draw), draw being uniform in [0, 1) and fixed for a document.

    With no labelled row every score is 0.5; with rows of one class only, its
    smoothed share.
    """
    size = 1 << settings.bits
    spark = texts.sparkSession
    total = texts.select("label").count()
    keep = min(1.0, settings.fit_rows / max(1, total))
    found = settle(texts.mapInArrow(collected(features, size, keep), "label int, draw double, row binary, counts binary"))
    pages = (
        found.where("counts is not null")
        .select("label", "draw", "counts")
        .repartition(min(16, size // 4096 or 1), "draw")
        .mapInArrow(summed, "label int, draw double, counts binary")
        .collect()
    )  # 2 x 2**bits counts, whatever the input
    counts = np.zeros((2, size), np.int64)
    for label, page, blob in pages:
        part = np.frombuffer(blob, np.int64)
        counts[label, int(page) * len(part) : (int(page) + 1) * len(part)] += part
    ones = texts.where("label = 1").select("label").count() if total else 0
    if not 0 < ones < total:
        return Model(np.zeros(size), np.zeros(size), 0.0, (ones + 1) / (total + 2))
    scale = ratios(counts, settings.smoothing, settings.sigmas)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[float, int, np.ndarray]] = []
        for batch in batches:
            for label, draw, blob in zip(*(batch.column(c).to_pylist() for c in ("label", "draw", "row")), strict=True):
                rows.append((draw, label, np.frombuffer(zlib.decompress(blob), np.uint32)))
        if not rows:
            return
        rows.sort(key=lambda x: (x[0], x[1], len(x[2]), x[2].tobytes()))
        fits = np.cumsum([len(x[2]) for x in rows]) <= settings.fit_features
        rows = [x for x, ok in zip(rows, fits, strict=True) if ok] or rows[:1]
        weights, bias = fit([x[2] for x in rows], np.array([x[1] for x in rows]), scale, settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([bias], pa.float64())], names=["weights", "bias"]
        )

    sample = found.where("row is not null").select("label", "draw", "row").repartition(1)
    fits = sample.mapInArrow(fitted, "weights binary, bias double").collect()
    del spark
    if not fits:
        return Model(scale, np.zeros(size), 0.0)
    return Model(scale, np.frombuffer(fits[0]["weights"], np.float64), fits[0]["bias"])


def score(texts: DataFrame, features: Features, model: Model, text: str, name: str, keep_text: bool = False) -> DataFrame:
    """``texts``, as a rule without ``text``, with ``name``: the score of each whole text."""
    if model.constant is not None:
        out = texts.withColumn(name, F.lit(model.constant))
        return out if keep_text else out.drop(text)
    # Two values a feature; 2**bits features bound what is sent to the workers.
    product = (model.weights * model.scale).astype(np.float32)
    square = (model.scale**2).astype(np.float32)
    bias = model.bias
    rest = [c for c in texts.columns if keep_text or c != text]
    schema = texts.select(*[F.col(f"`{c}`") for c in rest], F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, last, rows, found in grouped(batch.column(text), features):
                n = last - first
                dot = np.bincount(rows, product[found], n)
                size = np.sqrt(np.bincount(rows, square[found], n))
                out[first:last] = np.divide(dot, size, out=np.zeros(n), where=size > 0) + bias
            out = 1 / (1 + np.exp(-2 * np.clip(out, -50, 50)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(out)], names=[*rest, name])

    return texts.mapInArrow(run, schema)
