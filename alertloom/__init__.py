"""alertloom: security-alert analytics as Spark DataFrame, streaming and ML jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel with their code, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
