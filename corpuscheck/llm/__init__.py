"""Operators for large-scale training-data work and their registered queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. Its
functions travel to the executors by value, so a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
