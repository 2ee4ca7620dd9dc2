"""Operators for training-data pipelines. Nothing else in the library imports them.

Functions that run inside Python workers travel with their code, so that
executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
