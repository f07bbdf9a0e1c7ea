"""Operators for training-data pipelines; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# The functions travel with the jobs that use them, so workers need not have the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
