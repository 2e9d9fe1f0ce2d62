"""Operations of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries, ``oracles`` the DuckDB statements they are compared with.

Functions of this package travel to Python workers by value, so executors do not
need the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
