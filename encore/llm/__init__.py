"""Training-data operators: packing, near and exact deduplication, tokenizing,
extraction and classifiers. Nothing else in the library imports this package.

Its functions reach the executors by value, so that these need not have it installed."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
