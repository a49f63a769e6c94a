"""Operators for building training corpora; nothing outside this folder imports it.

The functions that run inside tasks are sent along with the tasks, so the executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
