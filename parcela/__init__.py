"""A Spark-first engine for collections of semi-structured reports."""

import sys

from pyspark import cloudpickle

# What runs in Python workers travels by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
