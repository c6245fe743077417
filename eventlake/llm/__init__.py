"""Training-data operators: tokenisation, quality, language, deduplication,
search, mixing and formatting.

Nothing else in the library imports this subpackage.  Functions defined here
are shipped to executors by value, so that a cluster needs no copy of the
package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
