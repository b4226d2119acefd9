"""Operators for preparing training text: deduplication, filters, scans, formatting, packing and token statistics.

Functions of this package that run inside tasks are sent to the executors by value, so executors need the third-party
libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
