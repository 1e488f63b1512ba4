"""Operators for preparing training corpora. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import scoreflow

# Executors need no copy of this package: what a task uses of it travels with the task.
cloudpickle.register_pickle_by_value(scoreflow)
