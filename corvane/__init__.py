"""Document-retrieval analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions for workers travel with their code, so a cluster needs no copy of the package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
