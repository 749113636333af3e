"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Python code of these modules runs in Spark tasks; it is pickled by value, so executors
need neither this repository on their path nor a shared installation of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
