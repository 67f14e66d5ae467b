"""Catalogue analytics on PySpark: pages and CSV drops to marts, search and answers."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel with their code: executors need not have this
# package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
