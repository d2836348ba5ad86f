"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from . import linear
from .quality import classified
from .text import char_ngrams

SETTINGS = linear.Settings(bits=18, fit_rows=8192, cost=4.0, squared=True, epochs=15)
SIZES = (3, 4, 5, 6)


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    fold: int = 0,
    sizes: tuple[int, ...] = SIZES,
    settings: linear.Settings = SETTINGS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document by its whole text.

    Features are the byte n-grams of lower-cased words with the white space
    around them.  Labels of rows in ``fold`` are not learnt from.  Labels other
    than 0 and 1, of unknown documents, and contradictory ones are ignored.  A
    null or empty text scores as one without features; repeated rows score
    alike; an empty table gives an empty result.  Only doc_id and text are read.
    """
    features = partial(char_ngrams, bits=settings.bits, sizes=sizes)
    return classified(documents, labels, "toxic", features, settings, folds, fold)
