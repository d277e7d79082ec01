"""Operators of a training-data pipeline; nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
