"""placefolio: place listings and recorded web pages -> priced catalogue, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions shipped to Python workers travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
