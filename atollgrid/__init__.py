"""Spark-native raster land-cover analytics."""

import sys

from pyspark import cloudpickle

# functions that run on executors travel with their code: executors needn't have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
