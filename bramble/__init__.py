"""Spark-native tabular preparation, similarity search, learning and evaluation jobs."""

import sys

from pyspark import cloudpickle

# task functions carry their code along, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
