"""Tidemark: a PySpark-native lakehouse analytics library.

``sources``    readers, sinks and the shared scratch area
``functions``  column expressions (text, dates, money, numbers, events, vectors)
``operators``  table-in / table-out operators
``streaming``  Structured Streaming drivers for change-data capture
``plans``      whole flows put together from the operators
``workload``   the registered queries with their SQL counterparts
"""

import sys

from pyspark import cloudpickle

from tidemark.session import build_session, durable, scratch_path

# Functions that run in Python workers travel with their code, so that workers need not have
# the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "durable", "scratch_path"]
