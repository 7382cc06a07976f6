"""Operators for large-scale training-data preparation."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a job
# needs no copy of it on every machine's import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
