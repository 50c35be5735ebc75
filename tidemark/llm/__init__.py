"""Training-data operators: quality, mixing, deduplication, URL filters,
fingerprints, packing, exact search, similarity join and chat formatting.

Each module holds one operator with its own general interface. The thin
registered queries are in ``queries``. Nothing else in the library imports
this subpackage.

Code that runs in Python workers is shipped by value, so executors need the
third-party libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
