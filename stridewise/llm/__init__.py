"""Operators for large training-data pipelines: archives, quality, dedup, privacy, mixing, packing, scoring.

Nothing else in the library imports this subpackage. Its functions that run in
Python workers are shipped by value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
