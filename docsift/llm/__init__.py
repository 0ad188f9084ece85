"""Operators of a training-data pipeline over web-scale document tables.

One module per operator, each with a general interface; ``queries`` registers
one query per operator. Python code that runs inside tasks travels by value, so
workers need the libraries it imports but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
