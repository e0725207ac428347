"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing outside this subpackage imports it. The functions that run in Python
workers are pickled by value, so executors need neither this package on their
path nor a copy of it in a shared folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
