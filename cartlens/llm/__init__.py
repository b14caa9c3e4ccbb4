"""Operators of a training-data pipeline (documents, embeddings, URLs).

Python functions that run inside tasks are pickled by value, so executors
need numpy, pyarrow and ``regex`` but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
