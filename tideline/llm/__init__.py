"""Training-data operators: each module holds one operator, `queries` registers them.

What runs inside tasks is sent to the executors by value, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
