"""Operators of a training-data pipeline over web-scale text tables.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered
queries and the top-level ``corpus_pipeline.py`` chains five of the operators.
Functions that run in tasks are shipped by value, so executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
