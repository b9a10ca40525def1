"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# functions for Python workers travel whole, so that executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
