"""Spark-native text-encoding functions; the optional ``llm`` subpackage holds training-data operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# executors need no copy of this package: its functions travel with the plan
cloudpickle.register_pickle_by_value(sys.modules[__name__])
