"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this subpackage; `corpus_pipeline.py` and
`__spark_entry__.py` do.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no
# copy of this package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
