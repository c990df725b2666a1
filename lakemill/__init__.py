"""A PySpark-native engine for URL, page and text corpora."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry the package's code, which need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
