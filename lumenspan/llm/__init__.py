"""Training-data operators: dedup, language, tokens, scores, licences, mixing and rules.

Nothing outside this subpackage imports it. Its functions travel to Python workers by value, so that executors need
no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
