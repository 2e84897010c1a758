"""Operators for preparing language-model training data. Nothing else in the library imports them.

Functions that run in tasks are pickled by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
