"""Operators for preparing language-model training data on Spark.

One module per operator, ``queries`` for the registered queries. Functions of
this subpackage travel to the executors by value, so that a cluster needs
no installed copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
