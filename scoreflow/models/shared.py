"""Sharing a Python model with the executors."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import SparkSession

import scoreflow

# A model that does not fit this is refused rather than shipped to every executor.
MAX_MODEL_BYTES = 1 << 30

# Executors need no copy of this package: what a task uses of it travels with the task.
cloudpickle.register_pickle_by_value(scoreflow)


class _ByValue:
    """Pickles as its content, so that classes from scripts and notebooks survive."""

    def __init__(self, content: bytes):
        self.content = content

    def __reduce__(self):
        return pickle.loads, (self.content,)


def broadcast_model(spark: SparkSession, model, max_bytes: int = MAX_MODEL_BYTES) -> Broadcast:
    """Ship a model once per executor; each Python worker decodes it once.

    `model` is any object with `predict(2-D array) -> 1-D array`, loaded by the
    caller from a place the caller trusts.
    """
    if not callable(getattr(model, "predict", None)):
        raise TypeError("a model needs a predict method")
    content = cloudpickle.dumps(model)
    if len(content) > max_bytes:
        raise ValueError(f"the model takes {len(content)} bytes, the limit is {max_bytes}")
    return spark.sparkContext.broadcast(_ByValue(content))
