"""driftloom: data quality, feature building, evaluation and drift operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python helpers that run in tasks travel with the query, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
