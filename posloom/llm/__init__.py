"""Corpus operators for training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
