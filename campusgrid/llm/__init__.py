"""Operators that prepare text for training language models.

Python code of this package runs inside tasks. It travels with the job, by value,
so that executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
