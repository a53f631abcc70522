"""Shaping, batching and delivery of log events on Spark."""

import sys

from pyspark import cloudpickle

# Tasks carry the few Python helpers with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
