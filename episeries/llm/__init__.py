"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package by value and need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
