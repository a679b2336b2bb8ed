"""lorefield: building and measuring retrieval corpora as Spark jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function, and every scalar
function is a ``Column -> Column`` expression.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
