"""Operators for training-data pipelines. Nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors with the tasks that call them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
