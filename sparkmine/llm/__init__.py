"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Functions of this subpackage travel to the Python workers by value, so executors need numpy, pyarrow
and the libraries that an operator names, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
