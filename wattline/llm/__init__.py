"""Operators for preparing training data; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the tasks, so Python workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
