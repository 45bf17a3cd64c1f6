"""Operators of a training-data pipeline over documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with the tasks that use them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
