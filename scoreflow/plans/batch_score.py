"""Batch jobs: a file of lines to predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from scoreflow.fixed_values import CHECKED_FIELD
from scoreflow.layouts import MRI11, FieldLayout
from scoreflow.models import TreeEnsemble
from scoreflow.operators import (
    drop_blank,
    parse_delimited,
    score_mllib,
    score_python,
    score_trees,
    with_dense_index,
)
from scoreflow.operators.keys import SortKeys


def score(df: DataFrame, model, columns: Sequence[str]) -> DataFrame:
    """Score with whatever kind of model is given: trees, an MLlib pipeline or its
    path, or a Python object with `predict`."""
    if isinstance(model, TreeEnsemble):
        return score_trees(df, model, columns)
    if isinstance(model, str) or hasattr(model, "transform"):
        return score_mllib(df, model)
    return score_python(df, model, columns)


def score_lines(
    lines: DataFrame,
    model,
    layout: FieldLayout = MRI11,
    checked: int | None = CHECKED_FIELD,
    policy: str = "strict",
    short_rows: str = "drop",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Check one field, parse, score: one stage, no shuffle."""
    rows = parse_delimited(lines, layout, policy, checked, short_rows, keep)
    return score(rows, model, layout.columns)


def score_indexed_lines(
    lines: DataFrame,
    model,
    layout: FieldLayout = MRI11,
    policy: str = "strict",
    order_by: SortKeys = (),
    keep: Sequence[str] = (),
    spread_ties: bool = True,
) -> DataFrame:
    """(`row_id`, `prediction`) for the nonblank lines, numbered from 0.

    The index is put on the parsed rows, so that neither it nor the scratch
    table it needs depends on how expensive the model is.
    """
    rows = parse_delimited(drop_blank(lines), layout, policy, keep=keep)
    indexed = with_dense_index(rows, order_by, spread_ties=spread_ties)
    return score(indexed, model, layout.columns).select("row_id", "prediction")
