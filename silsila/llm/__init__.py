"""Operators for training-data pipelines. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Task code travels with the task, so executors need Python and the libraries but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
