"""Operators for preparing training data; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions for executors travel by value, so that workers need not have the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
