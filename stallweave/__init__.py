"""Retail lakehouse analytics and retrieval as plain PySpark dataflows.

Every public function takes DataFrames (or Columns) and returns DataFrames (or Columns); Spark does the
reading, shuffling and writing.  See the README for the map from operator ids to modules.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
