"""Corpus operators for language-model training data; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors by value, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
