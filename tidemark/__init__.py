"""Temporal and similarity analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
