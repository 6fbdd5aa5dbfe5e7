"""Operators for preparing language-model training data. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Executors get the functions used in tasks with the task, and needn't have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
