"""SQL over named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make the table, bounded or streaming, known to `spark.sql` under `name`."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(text: str, views: dict[str, DataFrame], **args) -> DataFrame:
    """Run a SQL text over `views`; `:name` parameters are taken from `args`."""
    for name, df in views.items():
        register_view(df, name)
    spark = next(iter(views.values())).sparkSession
    return spark.sql(text, args=args or None)
