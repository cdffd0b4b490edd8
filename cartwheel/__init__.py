"""Shop-behaviour features on Spark: one set of definitions for batch tables and streams."""

import sys

from pyspark import cloudpickle

# Stateful processors and partition writers travel with the query; workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
