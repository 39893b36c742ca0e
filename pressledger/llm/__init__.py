"""Operators for preparing training data; each module holds one operator and its own docstring contract."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
