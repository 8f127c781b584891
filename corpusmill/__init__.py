"""corpusmill: a PySpark-native engine for corpus analytics and training-data preparation."""

import sys

from pyspark import cloudpickle

# The package's functions travel to the executors by value: they need no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
