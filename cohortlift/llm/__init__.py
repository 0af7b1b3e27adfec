"""Training-data operators: formatting, packing, deduplication, scanning, filtering.

Each module holds one operator; ``queries`` registers one query per operator.
Nothing else in the library imports this package.

Functions that run inside Spark tasks are shipped by value, so executors need
only the public packages, not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
