"""Spark-native analytics for logistics data: bookings, vehicle telemetry and weather feeds."""

import sys

from pyspark.cloudpickle import cloudpickle

__version__ = "0.1.0"

# functions that run in Spark's Python workers travel as code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
