"""Training-data operators: search, deduplication, filtering, mixing, packing.

Every operator takes a ``documents``-like DataFrame (``embeddings`` for the
vector search) and returns a DataFrame.  Nothing else in the library imports
this subpackage.
"""

import sys

from pyspark import cloudpickle

# Python workers get the functions they run with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
