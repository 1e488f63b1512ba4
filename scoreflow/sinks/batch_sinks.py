"""Sinks for a scored stream: callables that take (rows, batch)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from scoreflow.fixed_values import CONSOLE_ROWS, RESULT_COLUMNS
from scoreflow.functions.messages import key_minutes_line, result_time
from scoreflow.operators.batches import visit_partitions
from scoreflow.sinks import writers
from scoreflow.sinks.identity import id_header, with_message_id, with_place
from scoreflow.sinks.writers import Batch

Sink = Callable[[DataFrame, Batch], None]


def result_rows(
    df: DataFrame, key: str = "PNO", minutes: str = "minutes", stamp: Column | None = None
) -> DataFrame:
    """Rows of the result table: key, minutes and the time of writing, in session time."""
    return result_rows_of(df, key, minutes, stamp)


def result_rows_of(df: DataFrame, key: str, minutes: str, stamp: Column | None, *also: str) -> DataFrame:
    pno, pretime, time = RESULT_COLUMNS
    stamp = F.current_timestamp() if stamp is None else stamp
    return df.select(
        F.col(key).alias(pno), F.col(minutes).alias(pretime), result_time(stamp).alias(time), *also
    )


# `keyed=False` appends instead of replacing the batch's own partition. A repeated
# batch is then written twice, but a stream that runs for long makes no partition
# per batch.


def text_sink(path: str, line: Column | str, keyed: bool = True) -> Sink:
    return lambda df, batch: writers.write_text(df, path, line, "append", batch if keyed else None)


def key_minutes_sink(path: str, key: str = "PNO", minutes: str = "minutes", keyed: bool = True) -> Sink:
    """`key,minutes` lines."""
    return text_sink(path, key_minutes_line(F.col(key), F.col(minutes)), keyed)


def csv_sink(path: str, keyed: bool = True) -> Sink:
    return lambda df, batch: writers.write_csv(df, path, batch=batch if keyed else None)


def parquet_sink(path: str, keyed: bool = True) -> Sink:
    return lambda df, batch: writers.write_parquet(df, path, batch=batch if keyed else None)


def fitting(sink: Sink, reason: str = "reason") -> Sink:
    """`sink` for the rows without a reason to reject them; see parse_with_rejects."""
    return lambda df, batch: sink(df.filter(F.col(reason).isNull()).drop(reason), batch)


def rejects_sink(path: str, columns: Sequence[str] = ("line",), reason: str = "reason") -> Sink:
    """Rejected rows with their reasons, as Parquet; a batch that runs again replaces its own."""

    def write(df: DataFrame, batch: Batch) -> None:
        rejected = df.filter(F.col(reason).isNotNull()).select(*columns, reason)
        writers.write_parquet(rejected, path, batch=batch)

    return write


def result_table_sink(table: str, path: str | None = None, keyed: bool = True) -> Sink:
    def write(df: DataFrame, batch: Batch) -> None:
        writers.write_table(result_rows(df), table, path, batch if keyed else None)

    return write


def result_jdbc_sink(
    url: str, table: str, properties: dict[str, str], connections: int = 8, tag_batches: bool = False,
    tag_places: bool = False,
) -> Sink:
    """Result rows into a database table; with `tag_batches` each with its batch, with `tag_places` with its place
    there too, so that `first_delivery` can tell equal rows of a batch from rows that came again."""

    def write(df: DataFrame, batch: Batch) -> None:
        rows = placed_result_rows(df) if tag_places else result_rows(df)
        tag = batch if tag_batches or tag_places else None
        writers.write_jdbc(rows, url, table, properties, connections, tag)

    return write


def placed_result_rows(df: DataFrame, key: str = "PNO", minutes: str = "minutes", stamp: Column | None = None) -> DataFrame:
    """`result_rows` with `place`, which the time of writing has no part in."""
    return result_rows_of(with_place(df, [key, minutes]), key, minutes, stamp, writers.PLACE_COLUMN)


def kafka_sink(
    servers: str, topic: str, value: Column | str, key: Column | str | None = None, over: Sequence[str] | None = None
) -> Sink:
    """Messages to a topic. With `over`, the columns that make a message, each carries its id as a header, by which
    readers know a batch that came again (`sinks.each_once`)."""

    def write(df: DataFrame, batch: Batch) -> None:
        if over is None:
            writers.write_kafka(df, servers, topic, value, key)
        else:
            writers.write_kafka(with_message_id(df, batch, over), servers, topic, value, key, id_header())

    return write


def console_sink(rows: int = CONSOLE_ROWS) -> Sink:
    def show(df: DataFrame, batch: Batch) -> None:
        print(f"Batch: {batch[1]}")
        df.show(rows, truncate=False)

    return show


def partition_sink(fn: Callable[[Iterator[pd.DataFrame]], None]) -> Sink:
    """A sink of one's own: `fn` gets the rows of each partition in batches."""
    return lambda df, batch: visit_partitions(df, fn)
