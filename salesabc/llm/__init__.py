"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Its Python task
functions travel to the executors by value, so a job needs no installed
copy of the package on the workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
