"""Operators of a training-data pipeline: dedup, decontamination, language, toxicity, mixing, shards."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this folder: functions go to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
