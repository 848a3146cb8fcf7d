"""Operators for preparing training text.  Nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Tasks get these functions with the job, so executors need no installed copy of them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
