"""Order analytics and rule search as Spark jobs.

Every function takes and returns DataFrames. Only ``sinks``, ``streaming`` and
``staging`` write data.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so the package need not be installed
# there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
