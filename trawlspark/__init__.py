"""Web-corpus search on Spark: crawl decisions, page text, chunks, vectors and ranked answers as DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the workers inside the job, so executors need no copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
