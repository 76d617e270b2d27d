"""Operators for preparing training text: filtering, deduplication, extraction, packing and archives.

Functions of this package that run inside tasks are shipped by value, so Python workers need no
installed copy of it.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
