"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  Its task functions travel to the
executors by value, so a cluster needs numpy and pyarrow there but not this repository.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
