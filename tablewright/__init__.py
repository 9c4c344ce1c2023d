"""Declarative, Spark-native table building and training-data operations."""

import sys

from pyspark import cloudpickle

# functions for tasks travel whole: executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
