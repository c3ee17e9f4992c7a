"""Operators for building language-model training data. Nothing else in the
library imports this package."""

import sys

from pyspark import cloudpickle

# Executors get the functions themselves, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
