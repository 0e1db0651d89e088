"""Operators of a training-data pipeline; nothing else in the library imports this package.

Python functions of this package run inside Spark tasks. They are pickled by
value, so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
