"""Operators of a training-data pipeline: deduplication, cleaning, scoring and tokenisation of documents.

Every operator reads whole texts and keeps every row it is given. Functions of this package that run
in Python workers are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
