"""Operators for training-data pipelines; nothing else in the library imports this package.

Functions that run in tasks travel with the query, so the package need not be installed on the workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
