"""Locus and haplotype association analytics on Spark DataFrames.

Locus and dataset are ordinary columns everywhere: one Spark application
handles every region and every phenotype table at once.
"""

import sys

from pyspark import cloudpickle

from locusframe.config import Thresholds

# Functions of this package travel to executors by value, so that workers
# need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Thresholds"]
