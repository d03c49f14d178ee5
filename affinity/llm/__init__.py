"""Operators for building language-model training data, their queries and SQL.

Functions that run in Python workers are shipped by value, so executors need the third-party
libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
