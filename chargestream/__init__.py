"""Spark-native processing of EV-charging protocol traffic."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors inside the job, so the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
