"""Operators of a training-data pipeline.

Functions that run inside tasks are shipped by value, so executors need the third-party
libraries but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
