"""Training samples from advertising event logs, on Spark."""

import sys

from pyspark import cloudpickle

# Functions and stateful processors travel to the executors by value, so a
# cluster needs no separate installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
