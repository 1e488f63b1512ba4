"""Work on whole batches of rows in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Apply `fn` to Arrow-sized batches of each partition.

    Columns are not pruned through Python, so name the ones `fn` needs.
    """
    source = df if columns is None else df.select(*columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return source.mapInPandas(run, schema)


def visit_partitions(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], None]) -> None:
    """Run `fn` for its effect once per partition, e.g. with one connection each.

    A retried task visits its rows again, so `fn` should tolerate repeats.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn(batches)
        yield from ()

    df.mapInPandas(run, "done boolean").write.format("noop").mode("overwrite").save()
