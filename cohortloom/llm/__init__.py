"""Operators for training-data corpora.

Nothing else in the library imports this package.  Functions that run inside tasks travel by
value, so executors need the public libraries only and not this package on their path.
"""

import cohortloom
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(cohortloom)
