"""Operators for preparing large training corpora (text, pages, embeddings) on Spark.

Functions of this package that run inside tasks are sent to the executors by value, so the
Python workers need not have the package installed or on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
