"""tradewatch: trade-stream features, anomaly detection and market read models on PySpark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel by value, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
