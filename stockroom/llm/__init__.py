"""Training-data pipeline operators (scans, near-duplicates, cleaning, mixing, packing).

Nothing else in the library imports this package. Its functions travel to Spark's Python
workers by value, so workers need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
