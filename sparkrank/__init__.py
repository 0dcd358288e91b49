"""sparkrank: building and judging document retrieval with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel by value, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
