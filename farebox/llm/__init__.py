"""Operators of a training-data pipeline over whole document tables.

Python functions that run inside tasks travel with the job, so executors need no copy of this code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
