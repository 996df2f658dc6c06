"""Operators of a training-data pipeline; nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of this folder with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
