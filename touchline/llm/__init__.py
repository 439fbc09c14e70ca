"""Operators for preparing training data; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks carry the functions they need, so executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
