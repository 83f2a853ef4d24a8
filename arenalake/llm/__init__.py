"""Operators of a training-data pipeline; nothing outside this folder imports it but the entry file."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
