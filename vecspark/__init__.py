"""vecspark: vector search and the data work around it, as Spark DataFrame operators.

Functions take and return DataFrames and never create or configure a session.
"""

import sys

from pyspark import cloudpickle

# Functions run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
