"""Operators for training-data pipelines: filters, deduplication, mixing and token output."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors as code, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
