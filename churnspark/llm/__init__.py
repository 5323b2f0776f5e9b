"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

Functions of these modules travel to the executors by value, so the executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
