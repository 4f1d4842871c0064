"""Operators for preparing training corpora: cleaning, de-duplication, scoring, sharding, packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the task, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
