"""Sensor telemetry analytics as Spark DataFrame and Structured Streaming operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python kernels travel to the workers by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
