"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Functions that run in Python
workers are shipped by value, so executors need only the public libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
