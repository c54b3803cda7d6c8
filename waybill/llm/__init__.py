"""Operators for training-data corpora. Nothing outside this subpackage imports it.

Functions of this subpackage go to Python workers by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
