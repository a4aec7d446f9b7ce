"""Statistics over large tables, written as Spark DataFrame transformations."""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

# The few functions that run in Python on executors travel with their tasks, so that workers
# need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
