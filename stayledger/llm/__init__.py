"""Operators for preparing large text corpora.

Nothing outside this package imports it; deleting the folder leaves the rest of the
library working. Functions that run in Python tasks are sent by value, so executors
need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
