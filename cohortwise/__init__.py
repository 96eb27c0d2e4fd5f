"""Screening, profiling and evaluation of labelled tables as Spark DataFrame operators."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the task, so no executor needs it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
