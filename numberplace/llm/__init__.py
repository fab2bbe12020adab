"""Operators for training-data pipelines; nothing else in the library imports them.

Executors get the functions of the package with their tasks, so that it need
not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["numberplace"])
