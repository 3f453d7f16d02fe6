"""Operators for training-data corpora. Nothing else in the library imports this subpackage.

Functions that run in Python workers travel by value, so executors need none of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
