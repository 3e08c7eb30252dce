"""Operators for preparing large text corpora, and their registered queries.

Each module holds one operator with a general interface; ``queries`` applies
them to the tables of a data folder.  Nothing outside this subpackage (except
the guarded hook in ``__spark_entry__`` and ``corpus_pipeline``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster needs
# no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
