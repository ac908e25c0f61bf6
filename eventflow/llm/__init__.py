"""Operators that turn raw documents into training data."""

import sys

from pyspark import cloudpickle

# Functions that tasks run travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
