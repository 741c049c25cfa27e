"""Cohort variant, gene burden and association analytics on PySpark DataFrames."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Functions that run in Python workers travel with the task, so executors need not have
# this package installed.
register_pickle_by_value(sys.modules[__name__])
