"""Operators for training-data pipelines: deduplication, packing, language, licences, personal data.

Nothing else in the library imports this subpackage. Its functions are sent to the executors by value, so the
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
