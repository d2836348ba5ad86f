"""Quality classifier: a support vector machine over n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear
from .text import word_ngrams

SETTINGS = linear.Settings(bits=18, fit_rows=8192, cost=1.0, epochs=12)


def labelled(documents: DataFrame, labels: DataFrame, target: str, folds: int, fold: int) -> DataFrame:
    """(text, label, draw) of documents with a label that are not held out.

    Held-out rows go before the join; labels, the small side, are hashed there.
    ``draw`` is fixed by the id and spread evenly over [0, 1).
    """
    known = linear.one_label_a_document(labels, target)
    known = known.where(~linear.held_out(F.col("doc_id"), folds, fold))
    texts = documents.select("doc_id", "text").where(
        F.col("doc_id").isNotNull() & ~linear.held_out(F.col("doc_id"), folds, fold)
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit(target)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return texts.join(known.hint("shuffle_hash"), "doc_id").select("text", "label", draw.alias("draw"))


def classified(
    documents: DataFrame, labels: DataFrame, target: str, features, settings: linear.Settings, folds: int, fold: int
) -> DataFrame:
    model = linear.train(labelled(documents, labels, target, folds, fold), features, settings)
    rows = documents.select("doc_id", linear.held_out(F.col("doc_id"), folds, fold).alias("held_out"), "text")
    scored = linear.score(rows, features, model, "text", "score")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def quality_scores(
    documents: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, settings: linear.Settings = SETTINGS
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document by its whole text.

    Features are words, pairs of words, triples of word shapes and repeated
    words.  Labels of rows in ``fold`` are not learnt from.  Labels other than
    0 and 1, of unknown documents, and contradictory ones are ignored.  A null
    or empty text scores as one without features; repeated rows score alike;
    an empty table gives an empty result.  Only doc_id and text are read.
    """
    features = partial(word_ngrams, bits=settings.bits)
    return classified(documents, labels, "quality", features, settings, folds, fold)


def good_documents(
    documents: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, settings: linear.Settings = SETTINGS
) -> DataFrame:
    """The rows of ``documents`` that ``quality_scores`` predicts to be good, whole and unchanged."""
    features = partial(word_ngrams, bits=settings.bits)
    model = linear.train(labelled(documents, labels, "quality", folds, fold), features, settings)
    scored = linear.score(documents, features, model, "text", "__score", keep_text=True)
    return scored.where("__score >= 0.5").drop("__score")
