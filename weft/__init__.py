"""weft: a Spark-first analytics engine for event-sourced workflows."""

import sys

from pyspark import cloudpickle

# Functions of this package that run on executors are shipped by value, so a
# cluster needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
