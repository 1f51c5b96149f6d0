"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Its Python functions travel to the executors by value, so the workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
