"""Operators for preparing large text corpora for model training."""

import sys

from pyspark import cloudpickle

# Functions travel with their tasks, so executors need no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
