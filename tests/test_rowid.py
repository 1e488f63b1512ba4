import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from scoreflow.operators import distribute, rowid, with_dense_index


def test_equals_zip_with_index(spark):
    df = spark.range(1000).repartition(7)
    expected = sorted((i, row.id) for row, i in df.rdd.zipWithIndex().collect())
    got = sorted((r.row_id, r.id) for r in with_dense_index(df).collect())
    assert got == expected


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.integers(0, 300), partitions=st.integers(1, 12))
def test_dense_for_any_partitioning(spark, rows, partitions):
    df = distribute(spark.range(rows), partitions)
    assert sorted(r.row_id for r in with_dense_index(df).collect()) == list(range(rows))


@pytest.mark.parametrize("spread", [True, False])
def test_ordered(spark, spread):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("v")).repartition(5)
    got = with_dense_index(df, order_by="v", spread_ties=spread).collect()
    assert all(r.row_id == r.v for r in got) and len(got) == 500


def test_hot_key_is_spread_and_whole(spark):
    # Two thirds of the rows are copies of one row.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        indexed = with_dense_index(df.repartition(6), order_by="v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted((r.row_id, r.v) for r in indexed.collect())
    assert [i for i, _ in got] == list(range(3000))
    values = [v for _, v in got]
    assert values == sorted(values)
    sizes = [pq.ParquetFile(f.removeprefix("file:")).metadata.num_rows for f in indexed.inputFiles()]
    assert len(sizes) == 8 and max(sizes) < 600


def test_several_keys_descending(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (2, "c"), (1, "a")], "n int, s string")
    got = with_dense_index(df, order_by=[F.desc("n"), F.asc("s")]).orderBy("row_id").collect()
    assert [(r.n, r.s) for r in got] == [(2, "a"), (2, "c"), (1, "a"), (1, "b")]


def test_index_does_not_move_when_read_again(spark):
    df = with_dense_index(spark.range(200).withColumn("r", F.rand()).repartition(4))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, df.collect()))


def test_distribute_into_eleven(spark):
    assert distribute(spark.range(100), 11).rdd.getNumPartitions() == 11
    assert distribute(spark.range(100)).count() == 100


def test_streams_are_refused(spark, tmp_path):
    stream = spark.readStream.text(str(tmp_path))
    with pytest.raises(ValueError, match="bounded"):
        with_dense_index(stream)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange ")


def test_an_ordered_index_moves_rows_once(spark, monkeypatch):
    plans = []
    write = rowid._write_places

    def seen(df, label):
        plans.append(exchanges(df))
        return write(df, label)

    monkeypatch.setattr(rowid, "_write_places", seen)
    with_dense_index(spark.range(100), order_by="id", spread_ties=False).collect()
    assert plans == [1]
    plans.clear()
    with_dense_index(spark.range(100), order_by="id").collect()
    assert plans == [0, 1]
    plans.clear()
    with_dense_index(spark.range(100)).collect()
    assert plans == [0]


def test_a_frequent_value_is_split_without_places_too(spark):
    df = spark.range(3000).select(F.lit(1).alias("v"), "id").repartition(6)
    indexed = with_dense_index(df, order_by="v", spread_ties=False)
    assert sorted(r.row_id for r in indexed.collect()) == list(range(3000))
