"""Feature vectors held in array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from scoreflow.functions.sqltext import name


def int_vector(columns: Sequence[str]) -> Column:
    """One array<bigint> per row; fractions are truncated toward zero."""
    return F.expr("array(" + ", ".join(f"try_cast({name(c)} AS bigint)" for c in columns) + ")")


def truncate_vector(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.try_cast("bigint"))


def zip_rows(left: Column, right: Column, left_name: str, right_name: str) -> Column:
    """Generator: one row per pair of elements, as long as the shorter array, in the arrays' own types."""
    n = F.least(F.size(left), F.size(right))
    pair = lambda a, b: F.struct(a.alias(left_name), b.alias(right_name))
    return F.inline(F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(1), n), pair))
