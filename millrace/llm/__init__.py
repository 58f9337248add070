"""Operators for preparing training data.

Nothing else in the library imports this subpackage. Its functions are sent to executors by value, so
that a cluster needs no copy of the repository on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
