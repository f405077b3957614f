"""Operators for preparing large text corpora.

Each module holds one operator with its own interface; ``queries.py`` holds the
thin ``opN_<name>`` queries over the shared test tables.  Nothing else in the
library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# The helpers that run inside tasks travel with the job, so that executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
