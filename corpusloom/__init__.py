"""Spark jobs that prepare and analyse language-model training data."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the job, so that the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
