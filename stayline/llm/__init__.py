"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Workers need not have this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
