"""Operators for preparing language-model training data; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with them, so executors need no copy of this subpackage
cloudpickle.register_pickle_by_value(sys.modules[__name__])
