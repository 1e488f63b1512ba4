"""SQL job: text records as the table `people`, queried and written out."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from scoreflow.fixed_values import PEOPLE_QUERY, PEOPLE_VIEW
from scoreflow.layouts import PEOPLE9
from scoreflow.operators import parse_delimited, run_sql
from scoreflow.sinks import write_csv, write_parquet


def people(lines: DataFrame, policy: str = "strict") -> DataFrame:
    return parse_delimited(lines, PEOPLE9, policy)


def query_people(table: DataFrame, text: str = PEOPLE_QUERY, **args) -> DataFrame:
    """Run SQL over `people`. A Parquet-backed table gets the filter in its scan."""
    return run_sql(text, {PEOPLE_VIEW: table}, **args)


def export_people(table: DataFrame, csv_path: str, parquet_path: str) -> None:
    """Append the table as CSV and as Parquet, each in a folder of its own."""
    if csv_path.rstrip("/") == parquet_path.rstrip("/"):
        raise ValueError("CSV and Parquet need different folders")
    # Read and parsed once for both.
    table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_csv(table, csv_path)
        write_parquet(table, parquet_path)
    finally:
        table.unpersist()
