"""Customer behaviour analytics over retail transaction tables, as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
