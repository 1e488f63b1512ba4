"""Looking at a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scoreflow.operators.keys import SortKeys, sort_keys


def preview(df: DataFrame, n: int = 10, order_by: SortKeys = ()) -> DataFrame:
    """The first `n` rows; with `order_by` the same ones every time."""
    keys = sort_keys(order_by)
    return (df.orderBy(*keys) if keys else df).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column, one row per column."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position bigint, column_name string, column_type string, nullable boolean"
    )
