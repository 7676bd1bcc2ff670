"""Operators for preparing language-model training data; nothing else in the library imports this package.

Their functions travel to the Python workers by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
