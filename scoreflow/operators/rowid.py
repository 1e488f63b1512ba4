"""Dense row index and table distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from scoreflow.functions.sqltext import name as name_of
from scoreflow.operators.keys import SortKeys, sort_keys
from scoreflow.session import scratch_path

_POSITION_BITS = 33


def distribute(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread a table over `partitions`, or over as many as its size asks for."""
    if partitions is None:
        return df.hint("rebalance")
    return df.repartition(partitions)


def with_dense_index(
    df: DataFrame,
    order_by: SortKeys = (),
    name: str = "row_id",
    spread_ties: bool = True,
) -> DataFrame:
    """Add 0..n-1 as `name`: in partition order, or in the order of `order_by`.

    Rows are first written with their place (partition, position) to the shared
    scratch folder. From then on the place is data, so that a lost executor, a
    retried task or a changed plan cannot move a row between the two passes
    that the index needs. The second pass reads the place column alone, counts
    rows per partition and turns the counts into offsets.

    With `order_by`, rows are range-partitioned by those columns and, among
    equal ones, by their place in the input. No two rows share that key, so a
    value that a third of all rows hold is still split over many tasks. Range
    partitioning looks at its input twice, so the input is evaluated into that
    first write and only once.

    `spread_ties=False` saves that write: ties are then ordered by a hash of the
    whole row, and the input is evaluated twice. A frequent value is split all the
    same, unless its rows are equal in every column. It is meant for keys that are
    unique in an input that is cheap to read, such as a table's own key.
    """
    if df.isStreaming:
        raise ValueError("a dense index needs a bounded table; use it inside foreachBatch")
    keys = sort_keys(order_by)
    if not keys:
        placed = _write_places(df, "index")
    else:
        source, ties = df, [F.xxhash64(*map(name_of, df.columns))]
        if spread_ties:
            source, ties = _write_places(df, "index-input"), ["_place"]
        ranged = source.repartitionByRange(*keys, *ties).sortWithinPartitions(*keys, *ties)
        placed = _write_places(ranged.select(*df.columns), "index")

    partition = F.shiftright("_place", _POSITION_BITS)
    counts = placed.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition, so a single window partition stays small.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    # 16 bytes for each task of the job that wrote the rows: less than the driver held to run it.
    offsets = F.broadcast(offsets)
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_partition", partition)
        .join(offsets, "_partition")
        .select((F.col("_offset") + position).alias(name), *df.columns)
    )


def _write_places(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    schema = StructType([*df.schema.fields, StructField("_place", LongType())])
    return spark.read.schema(schema).parquet(path)
