"""Operators of a training-data pipeline, one module each; `queries.py` registers them.

Functions of this package that run in tasks are sent with the task, so
executors need only the libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
