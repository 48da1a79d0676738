"""Spark-native feature tables, validation splits and stacked classifiers."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors carry this package's code with them, so that workers need no
# copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
