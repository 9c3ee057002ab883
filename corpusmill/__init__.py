"""Document retrieval and answer-quality jobs as plain PySpark DataFrame functions.

Every public function takes DataFrames (or a session and a name) and returns a
DataFrame; nothing keeps a global session and nothing is computed on the driver
except values whose size is bounded by a parameter (cell centroids, rule tables,
a query batch below a checked byte budget).
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers carry their code along, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
