"""Operations for training-data pipelines over documents, pages and conversations.

Functions that run inside tasks are sent to the executors by value, so that a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
