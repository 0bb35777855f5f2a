"""Data mining on Spark DataFrames: near-duplicate text, frequent itemsets, triangle streams."""

import sys

from pyspark import cloudpickle

# Ship functions of this package with the job, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
