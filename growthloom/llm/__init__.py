"""Operators for building language-model training data, and their queries.

Nothing else in the library imports this subpackage. Its functions are
pickled by value, so executors need no copy of the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
