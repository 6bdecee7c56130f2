"""tagreef: build and query a large searchable image catalog with Spark."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so the
# workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
