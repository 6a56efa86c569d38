"""Corpus preparation, training order and run telemetry as Spark jobs."""

import sys

from pyspark import cloudpickle

from corpusflow.session import build_session, spread, stored, work_dir

# Python tasks carry this package's functions along, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "spread", "stored", "work_dir"]
