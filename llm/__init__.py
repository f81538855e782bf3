"""Operators for preparing large text corpora: classifiers, deduplication, decontamination, encoding, search.

Nothing else in the repository imports this package.
"""

import sys

from pyspark import cloudpickle

# Executors get these modules with the tasks and with what ``common.Sent`` carries, so they need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
