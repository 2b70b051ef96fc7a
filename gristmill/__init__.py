"""Corpus inventory, site-location quality and monthly policy datamarts as lazy Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in tasks travel with the job, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
