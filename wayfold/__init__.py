"""wayfold: a PySpark-native engine for vehicle traces and for training-data corpora.

Functions of this package are pickled by value, so executors need only the
libraries that the functions import, not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
