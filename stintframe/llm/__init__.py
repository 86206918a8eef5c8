"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Task functions travel with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
