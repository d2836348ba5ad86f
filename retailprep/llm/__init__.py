"""Operators for preparing training text, over DataFrames of documents, vectors and pages.

Functions that run in Spark's Python workers are shipped by value, so that
workers need this package's code from nowhere else.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
