"""Predictions from pre-trained regressors.

Each function adds one double column and keeps the others. All work on bounded
and streaming tables alike, and none moves rows between partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from scoreflow.functions.numbers import truncate, whole_minutes
from scoreflow.models.masks import TreeMasks
from scoreflow.models.shared import broadcast_model
from scoreflow.models.trees import TreeEnsemble

FORMS = ("column", "masks", "arrow")


def score_trees(
    df: DataFrame,
    model: TreeEnsemble,
    columns: Sequence[str] | None = None,
    name: str = "prediction",
    form: str = "column",
) -> DataFrame:
    """Score a tree ensemble as one Column ("column"), as bit masks ("masks") or in Arrow batches ("arrow").

    All give the same predictions and refuse the same calls. A Column and masks stay
    in the JVM; some hundred splits outgrow a Column's generated method, which the JIT
    does not compile then, and masks or arrays are faster. The caller chooses, so that
    a plan does not change with the model.
    """
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, got {form!r}")
    names = model.checked_columns(columns)
    if form == "column":
        return df.withColumn(name, model.to_column(names))
    if form == "masks":
        return TreeMasks(model).score(df, names, name)
    return score_python(df, model, names, name)


def score_python(
    df: DataFrame, model, columns: Sequence[str], name: str = "prediction"
) -> DataFrame:
    """Score any object with `predict(2-D array) -> 1-D array`, or its broadcast.

    Only `columns` travel to Python, in Arrow batches.
    """
    shared = model if isinstance(model, Broadcast) else broadcast_model(df.sparkSession, model)
    return df.withColumn(name, python_scorer(shared)(*columns))


def python_scorer(shared: Broadcast) -> Callable[..., Column]:
    """A vectorised scoring function over feature columns, for `select` or SQL use."""

    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        model = shared.value
        for features in batches:
            known = np.ones(len(features[0]), dtype=bool)
            if getattr(model, "accepts_missing", False):
                features = [f.cast("double").fill_null(float("nan")) for f in features]
            for feature in features:
                if feature.null_count:
                    known &= feature.is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros(len(known))
            if known.any():
                whole = features if known.all() else [f.filter(pa.array(known)) for f in features]
                rows = np.column_stack([f.to_numpy(zero_copy_only=False) for f in whole])
                out[known] = np.asarray(model.predict(rows)).reshape(-1)
            yield pa.array(out, mask=~known)

    return F.arrow_udf(score, "double")


def score_mllib(
    df: DataFrame, model: PipelineModel | str, name: str = "prediction", output: str = "prediction"
) -> DataFrame:
    """Score a fitted MLlib pipeline, given itself or by its path.

    The columns the stages add on the way, such as the feature vector, are dropped.
    """
    if isinstance(model, str):
        model = PipelineModel.load(model)
    return model.transform(df).select(*df.columns, F.col(output).alias(name))


def with_seconds(df: DataFrame, prediction: str = "prediction", name: str = "seconds") -> DataFrame:
    return df.withColumn(name, truncate(F.col(prediction)))


def with_minutes(df: DataFrame, prediction: str = "prediction", name: str = "minutes") -> DataFrame:
    return df.withColumn(name, whole_minutes(F.col(prediction)))
