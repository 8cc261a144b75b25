"""Operators for large training-data corpora, one module per operator.

``catalog.py`` holds the registered queries (``opN_<name>``) and their SQL twins.
Functions of this package that run inside Spark tasks are pickled by value, so the
executors need no copy of the package and no archive has to be shipped.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
