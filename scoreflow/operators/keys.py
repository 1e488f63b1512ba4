"""Sort keys as callers give them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column

SortKeys = str | Column | Sequence[str | Column]


def sort_keys(given: SortKeys) -> list[str | Column]:
    return [given] if isinstance(given, (str, Column)) else list(given)
