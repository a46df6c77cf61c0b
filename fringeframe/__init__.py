"""fringeframe: radio-interferometer data work as Spark DataFrame operators."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run inside tasks travel by value, so executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
