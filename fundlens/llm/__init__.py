"""Operators for preparing training text: packing, filters, scoring, joins, extraction, sharding.

Nothing else in the package imports this subpackage. Functions that run in
Python workers travel by value, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
