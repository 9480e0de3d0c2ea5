"""Operators for preparing training text: filters, deduplication, packing, token files."""

import sys

from pyspark import cloudpickle

# Task functions travel to the workers as code, wherever the package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
