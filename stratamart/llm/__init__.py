"""Operators for preparing training text: ten methods, one module each, and their named queries."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with their code, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
