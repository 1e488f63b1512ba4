"""Starting streams and feeding several sinks from one scoring pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from scoreflow.fixed_values import CONSOLE_ROWS, KAFKA_INTERVAL
from scoreflow.operators.keys import SortKeys
from scoreflow.operators.rowid import with_dense_index
from scoreflow.sinks import Sink
from scoreflow.sinks.writers import Batch
from scoreflow.streaming.ledger import Ledger


def fan_out(
    sinks: Sequence[Sink], stream_id: str | None = None, ledger: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that hands each micro-batch to the sinks in turn.

    With several sinks the batch is kept while they run, so it is read and scored once. A sink that
    fails fails the batch; it then runs again under the same batch id, which
    file and table sinks answer by replacing what they wrote. `stream_id` keeps
    the batches of different streams apart in one sink; by default it is the
    query's own id, which belongs to its checkpoint.

    With `ledger`, a folder, each sink that is done with a batch is marked there by its place in `sinks`, and
    a batch that runs again passes it by: databases, topics and appended files get a batch once though a later
    sink failed. Only a driver that dies between a sink's end and its mark lets that one sink run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        context = batch.sparkSession.sparkContext
        source = stream_id or context.getLocalProperty("sql.streaming.queryId")
        marks = Ledger(batch.sparkSession, ledger) if ledger else None
        waiting = [
            (f"sink-{place}", sink) for place, sink in enumerate(sinks)
            if marks is None or not marks.done((source, batch_id), f"sink-{place}")
        ]
        if len(waiting) > 1:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, sink in waiting:
                sink(batch, (source, batch_id))
                if marks is not None:
                    marks.write((source, batch_id), name)
        finally:
            if len(waiting) > 1:
                batch.unpersist()
        if marks is not None:
            marks.forget_before((source, batch_id))

    return write


def start_fan_out(
    df: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    interval: str | None = KAFKA_INTERVAL,
    stream_id: str | None = None,
    name: str | None = None,
    ledger: bool = False,
) -> StreamingQuery:
    """Start a stream into `sinks`; `interval=None` takes what is there and stops. `ledger=True` keeps marks of
    finished sinks beside the checkpoint (see `fan_out`)."""
    writer = _prepared(df, checkpoint, interval, name)
    return writer.foreachBatch(fan_out(sinks, stream_id, ledger_folder(checkpoint) if ledger else None)).start()


def ledger_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-ledger"


def numbered(sink: Sink, ledger: str, order_by: SortKeys = (), name: str = "row_id") -> Sink:
    """`sink` for rows with a dense number that goes on from batch to batch: 0..n-1 over the whole stream.

    Where a batch's numbers end is marked in `ledger`, a folder, before `sink` runs. A batch that runs again begins
    where the one before it ended, so its numbers are the same set; `order_by` also gives each row the same one.
    """

    def write(df: DataFrame, batch: Batch) -> None:
        marks = Ledger(df.sparkSession, ledger)
        stream, number = batch
        begin = marks.value((stream, number - 1), "rows") if number else "0"
        if begin is None:
            raise ValueError(f"batch {number - 1} of {stream} has left no count of its rows")
        rows = with_dense_index(df, order_by, name)
        rows = rows.withColumn(name, F.col(name) + F.lit(int(begin)).cast("bigint"))
        marks.write(batch, "rows", str(int(begin) + df.count()))
        sink(rows, batch)
        marks.forget_before(batch)

    return write


def sql_sink(text: str, sink: Sink, view: str = "batch") -> Sink:
    """`sink` for the result of a SQL text over each micro-batch, which it sees as `view`.

    The view lives in the session of the batch, for as long as the sink runs, so streams do not see each other's.
    """

    def write(df: DataFrame, batch: Batch) -> None:
        session = df.sparkSession
        df.createOrReplaceTempView(view)
        try:
            sink(session.sql(text), batch)
        finally:
            session.catalog.dropTempView(view)

    return write


def start_files(
    df: DataFrame,
    fmt: str,
    path: str,
    checkpoint: str,
    interval: str | None = KAFKA_INTERVAL,
    name: str | None = None,
    **options,
) -> StreamingQuery:
    """Start a stream into text, CSV or Parquet files, each row exactly once."""
    writer = _prepared(df, checkpoint, interval, name)
    return writer.format(fmt).options(**options).start(path)


def start_table(
    df: DataFrame, table: str, checkpoint: str, interval: str | None = KAFKA_INTERVAL, **options
) -> StreamingQuery:
    return _prepared(df, checkpoint, interval, None).options(**options).toTable(table)


def start_kafka(
    records: DataFrame, servers: str, topic: str, checkpoint: str, interval: str | None = KAFKA_INTERVAL
) -> StreamingQuery:
    """Publish (`key`, `value`) rows to a topic."""
    writer = _prepared(records, checkpoint, interval, None).format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic).start()


def start_console(
    df: DataFrame, checkpoint: str | None = None, interval: str | None = KAFKA_INTERVAL, rows: int = CONSOLE_ROWS
) -> StreamingQuery:
    writer = _prepared(df, checkpoint, interval, None).format("console")
    return writer.option("numRows", rows).option("truncate", False).start()


class RowVisitor:
    """A visitor of rows with a life cycle, for `start_visitor`: subclass it and override what is needed.

    `open` gets the partition and the epoch, once for each, e.g. to connect; if it returns False, the partition's rows
    are passed by, which is how a visitor that keeps its finished (partition, epoch) pairs, best in the same
    transaction as its rows, skips those that a retried task or a restarted stream brings again. `close` comes last,
    with the error if there was one.
    """

    def open(self, partition: int, epoch: int) -> bool:
        return True

    def process(self, row: Row) -> None:
        """Gets every row of an opened partition."""

    def close(self, error: Exception | None) -> None:
        pass


def start_visitor(
    df: DataFrame, visit: Callable[[Row], None] | RowVisitor, checkpoint: str, interval: str | None = KAFKA_INTERVAL
) -> StreamingQuery:
    """Run `visit`, a function or a RowVisitor, for every row; row by row in Python, so for small feeds and debugging."""
    return _prepared(df, checkpoint, interval, None).foreach(visit).start()


def _prepared(
    df: DataFrame, checkpoint: str | None, interval: str | None, name: str | None
) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append")
    if name:
        writer = writer.queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
