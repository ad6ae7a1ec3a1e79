"""Operators for preparing training data; nothing else in the library imports them.

Functions that run in tasks travel by value, so executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
