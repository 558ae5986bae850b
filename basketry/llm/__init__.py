"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_<name>`` queries over the test tables and ``oracles`` their SQL.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
