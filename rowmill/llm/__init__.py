"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
