"""Training-data operators: one module per operator, one query per operator in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so a cluster needs no copy of it on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
