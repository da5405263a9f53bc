"""rillstone: table operators for Spark, written as DataFrame -> DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent by value: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
