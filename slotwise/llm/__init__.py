"""Operators for large training-data corpora (documents, pages, benchmark sets).

Nothing else in the package imports this one.  Its functions run inside
executor tasks, so the package is pickled by value: executors need no
installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
