"""Writing bounded tables: files, catalog tables, JDBC, Kafka.

Writers used from a stream get `batch`, the pair (stream id, batch id). File
and table writers then put the rows into a partition of that name and replace
it as a whole, so a batch that runs again leaves one copy.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, DataFrameWriter, functions as F

from scoreflow.functions.sqltext import literal

Batch = tuple[str, int]
BATCH_COLUMNS = ("stream_id", "batch_id")
PLACE_COLUMN = "place"


def write_text(
    df: DataFrame, path: str, line: Column | str | None = None, mode: str = "errorifexists", batch: Batch | None = None
) -> None:
    """One line per row: `line`, or the only column as text."""
    if line is None:
        if len(df.columns) != 1:
            raise ValueError("name the line to write, the table has several columns")
        line = df.columns[0]
    column = F.col(line) if isinstance(line, str) else line
    lines = df.select(column.cast("string").alias("value"))
    writer, target = _writer(lines, path, mode, batch)
    writer.text(target)


def write_csv(
    df: DataFrame, path: str, mode: str = "append", header: bool = False, batch: Batch | None = None
) -> None:
    writer, target = _writer(df, path, mode, batch)
    writer.option("header", header).csv(target)


def write_parquet(df: DataFrame, path: str, mode: str = "append", batch: Batch | None = None) -> None:
    """Give Parquet a folder of its own: a reader cannot tell it from other files there."""
    writer, target = _writer(df, path, mode, batch)
    writer.parquet(target)


def write_table(
    df: DataFrame, table: str, path: str | None = None, batch: Batch | None = None
) -> None:
    """Append to a catalog table, which is made at the first call."""
    spark = df.sparkSession
    rows = df if batch is None else _tagged(df, batch)
    if not spark.catalog.tableExists(table):
        empty = rows.limit(0).write.format("parquet")
        if path is not None:
            empty = empty.option("path", path)
        if batch is not None:
            empty = empty.partitionBy(*BATCH_COLUMNS)
        empty.mode("ignore").saveAsTable(table)
    if batch is None:
        rows.select(*spark.table(table).columns).write.insertInto(table)
        return
    # Name the partition: an overwriting insertInto() would empty the whole table.
    columns = [c for c in spark.table(table).columns if c not in BATCH_COLUMNS]
    stream_id, batch_id = batch
    target = f"{table} PARTITION (stream_id = {literal(stream_id)}, batch_id = {int(batch_id)})"
    target = target.replace("{", "{{").replace("}", "}}")
    spark.sql(f"INSERT OVERWRITE TABLE {target} SELECT * FROM {{rows}}", rows=df.select(*columns))


def jdbc_options(properties: dict[str, str], connections: int = 8, batch_rows: int = 10_000) -> dict[str, str]:
    """Connection properties plus bounds: many executors must not open many connections."""
    return {"numPartitions": str(connections), "batchsize": str(batch_rows), **properties}


def jdbc_rows(df: DataFrame, connections: int = 8, batch: Batch | None = None) -> DataFrame:
    """The rows a database gets, dealt out to its connections.

    Spark's own limit on connections narrows the whole stage before them; here the
    small result rows move, and reading and scoring keep all their tasks.
    """
    return (df if batch is None else _tagged(df, batch)).repartition(connections)


def first_delivery(rows: DataFrame) -> DataFrame:
    """Rows of a table written with `batch`, without those that a repeated batch wrote again.

    Rows with a `place` (see `sinks.with_place`) are told apart by it: equal rows of one batch stay as many
    as they are. Without places equal rows of one batch become one, unless the rows have a key.
    """
    # Rows are dealt out by what tells them apart before they are compared: a task then holds the rows of one
    # shuffle partition, not those of a whole file it read, which are nearly all different.
    if PLACE_COLUMN in rows.columns:
        keys = [*BATCH_COLUMNS, PLACE_COLUMN]
        return rows.repartition(*keys).dropDuplicates(keys)
    return rows.repartition(*rows.columns).dropDuplicates()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    connections: int = 8,
    batch: Batch | None = None,
) -> None:
    """Append to a database table over JDBC.

    JDBC cannot replace a part of a table. With `batch`, its columns are
    written too, so that readers can tell a repeated batch.
    """
    rows = jdbc_rows(df, connections, batch)
    rows.write.jdbc(url, table, mode="append", properties=jdbc_options(properties, connections))


def kafka_records(
    df: DataFrame, value: Column | str, key: Column | str | None = None, headers: Column | None = None
) -> DataFrame:
    """The `value` (and `key`, and `headers`) columns Kafka takes."""

    def text(c: Column | str) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("string")

    columns = [text(value).alias("value")]
    if key is not None:
        columns.insert(0, text(key).alias("key"))
    if headers is not None:
        columns.append(headers.alias("headers"))
    return df.select(*columns)


def write_kafka(
    df: DataFrame, servers: str, topic: str, value: Column | str, key: Column | str | None = None,
    headers: Column | None = None,
) -> None:
    records = kafka_records(df, value, key, headers)
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def _tagged(df: DataFrame, batch: Batch) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in zip(BATCH_COLUMNS, batch)})


def _writer(df: DataFrame, path: str, mode: str, batch: Batch | None) -> tuple[DataFrameWriter, str]:
    """A writer and where it writes; a batch overwrites the folder of its own partition."""
    if batch is None:
        return df.write.mode(mode), path
    folders = [f"{c}={quote(str(v), safe='')}" for c, v in zip(BATCH_COLUMNS, batch)]
    return df.write.mode("overwrite"), "/".join([path.rstrip("/"), *folders])
