"""Messages that can be told apart, and readers that take each once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scoreflow.functions.sqltext import name as name_of
from scoreflow.sinks.writers import Batch

PLACE, MESSAGE_ID = "place", "message_id"


def with_place(df: DataFrame, over: Sequence[str] | None = None, name: str = PLACE) -> DataFrame:
    """Each row's place in its batch: a hash of the columns `over` (all by default) and the row's number among those
    that are equal in them.

    Places depend on the rows alone. A batch that runs again gives the same ones, however its rows are dealt out by
    then. Leave out columns that change with every run, such as the time of writing. Equal rows get places that
    differ; which of them gets which is open, and makes no difference.
    """
    columns = list(over or df.columns)
    nulls = [F.col(name_of(c)).isNull() for c in columns]
    one = F.xxhash64(*(name_of(c) for c in columns), *nulls)
    two = F.xxhash64(F.lit(1), *nulls, *(name_of(c) for c in columns))
    text = F.concat_ws("-", F.lower(F.hex("_one")), F.lower(F.hex("_two")), F.col("_nth").cast("string"))
    if set(columns) == set(df.columns):
        # Rows equal in all columns can stand for each other: count each group and give the count back as rows
        # numbered 1 to n. A window over equal rows would hold a whole group in one task.
        kept = [F.first(name_of(c)).alias(c) for c in df.columns]
        groups = df.groupBy(one.alias("_one"), two.alias("_two")).agg(*kept, F.count(F.lit(1)).alias("_n"))
        placed = groups.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
        return placed.select(*(F.col(name_of(c)) for c in df.columns), text.alias(name))
    equal = Window.partitionBy("_one", "_two").orderBy(F.lit(0))
    placed = df.withColumns({"_one": one, "_two": two}).withColumn("_nth", F.row_number().over(equal))
    return placed.withColumn(name, text).drop("_one", "_two", "_nth")


def with_message_id(df: DataFrame, batch: Batch, over: Sequence[str] | None = None, name: str = MESSAGE_ID) -> DataFrame:
    """(stream, batch, place) of each row as one text."""
    stream, number = batch
    placed = with_place(df, over, "_place")
    return placed.withColumn(name, F.concat_ws("/", F.lit(str(stream)), F.lit(str(int(number))), "_place")).drop("_place")


def id_header(name: str = MESSAGE_ID) -> Column:
    """The id as a topic record's header, beside a value that outside readers know."""
    return F.array(F.struct(F.lit(name).alias("key"), F.encode(F.col(name), "UTF-8").alias("value"))).alias("headers")


def each_once(stream: DataFrame, time: str, delay: str, name: str = MESSAGE_ID) -> DataFrame:
    """The messages of a stream without repeats. State holds the ids of the last `delay` of event time, so a repeat is
    known if its time lies within that of the first one; a batch that runs again does so soon after."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([name])
