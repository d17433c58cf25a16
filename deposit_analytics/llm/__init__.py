"""Operators for training-data pipelines over text corpora."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with their task, so that executors need
# no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
