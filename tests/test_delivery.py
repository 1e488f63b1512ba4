"""Ledger, message ids, places, row visitors and numbers over batches."""

import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from scoreflow.sinks import each_once, first_delivery, kafka_records, id_header, parquet_sink, with_message_id, with_place
from scoreflow.sources import stream_parquet
from scoreflow.streaming import Ledger, RowVisitor, fan_out, ledger_folder, numbered, sql_sink, start_fan_out, start_visitor


@pytest.fixture
def stream(spark, tmp_path):
    """Nine rows in three files, so three micro-batches."""
    path = str(tmp_path / "in")
    for part in range(3):
        spark.range(part * 3, part * 3 + 3).withColumn("x", F.lit("same")).coalesce(1).write.mode("append").parquet(path)
    return stream_parquet(spark, path, "id bigint, x string", max_files=1)


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "marks"))
    assert not ledger.done(("s/1", 4), "sink 0") and ledger.value(("s/1", 4), "n") is None
    ledger.write(("s/1", 4), "sink 0")
    ledger.write(("s/1", 4), "n", "12")
    ledger.write(("s/1", 4), "n", "13")  # the first one stays
    assert ledger.done(("s/1", 4), "sink 0") and ledger.value(("s/1", 4), "n") == "12"
    assert not ledger.done(("s/1", 5), "sink 0") and not ledger.done(("s", 4), "sink 0")
    ledger.forget_before(("s/1", 5))
    assert ledger.done(("s/1", 4), "sink 0")
    ledger.forget_before(("s/1", 6))
    assert not ledger.done(("s/1", 4), "sink 0")


@pytest.mark.parametrize("with_ledger", [True, False])
def test_a_failing_sink_and_the_others(spark, stream, tmp_path, with_ledger):
    seen, failed = [], []

    def fails(df, batch):
        if batch[1] == 1 and not failed:
            failed.append(batch)
            raise RuntimeError("once")
        seen.append(("late", batch[1], df.count()))

    sinks = [lambda df, batch: seen.append(("early", batch[1], df.count())), fails]
    checkpoint = str(tmp_path / "checkpoint")
    with pytest.raises(StreamingQueryException):
        start_fan_out(stream, sinks, checkpoint, interval=None, ledger=with_ledger).awaitTermination()
    start_fan_out(stream, sinks, checkpoint, interval=None, ledger=with_ledger).awaitTermination()
    early = [n for name, n, _ in seen if name == "early"]
    assert sorted(early) == ([0, 1, 2] if with_ledger else [0, 1, 1, 2])
    assert sorted(n for name, n, _ in seen if name == "late") == [0, 1, 2]
    assert all(rows == 3 for _, _, rows in seen)
    if with_ledger:  # marks of old batches are gone
        assert len(glob.glob(f"{ledger_folder(checkpoint)}/*/*")) == 2


def test_places_are_the_same_however_rows_lie(spark):
    rows = [("a", 1, 0.5), ("a", 1, 0.7), ("a", None, 0.1), (None, 1, 0.2), (None, 1, 0.3), ("b", 1, 0.4)] * 3
    df = spark.createDataFrame(rows, "k string, n int, time double")
    one, two = (sorted(r["place"] for r in with_place(df.repartition(n), ["k", "n"]).collect()) for n in (1, 5))
    assert one == two and len(set(one)) == len(rows)
    delivered = with_place(df, ["k", "n"]).withColumns({"stream_id": F.lit("s"), "batch_id": F.lit(1)}).drop("time")
    again = delivered.unionByName(delivered.repartition(3))
    assert first_delivery(again).count() == len(rows)
    assert first_delivery(again.unionByName(delivered.withColumn("batch_id", F.lit(2)))).count() == 2 * len(rows)
    assert first_delivery(again.drop("place")).count() == 4  # without places equal rows are one
    assert with_place(df.limit(0)).count() == 0


def test_message_ids_as_headers(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1)], "k string, n int")
    records = kafka_records(with_message_id(df, ("s", 3)), "k", "n", id_header())
    assert records.columns == ["key", "value", "headers"]
    ids = {bytes(r["headers"][0]["value"]).decode() for r in records.collect()}
    assert len(ids) == 2 and all(i.startswith("s/3/") for i in ids)


def test_each_once_over_batches(spark, tmp_path):
    path, target = str(tmp_path / "topic"), str(tmp_path / "out")
    for _ in range(2):
        spark.range(5).select(F.concat(F.lit("s/0/"), "id").alias("message_id"), F.current_timestamp().alias("sent")).coalesce(
            1).write.mode("append").parquet(path)
    read = each_once(stream_parquet(spark, path, "message_id string, sent timestamp", max_files=1), "sent", "1 hour")
    start_fan_out(read, [parquet_sink(target)], str(tmp_path / "checkpoint"), interval=None).awaitTermination()
    assert spark.read.parquet(target).count() == 5


def file_visitor(folder):
    class Files(RowVisitor):  # here, so that it travels to the workers by value
        """Writes a file for each finished (partition, epoch), and fails once in the middle of one."""

        def __init__(self, folder):
            self.folder = folder

        def open(self, partition, epoch):
            self.path, self.rows = f"{self.folder}/{partition}-{epoch}", []
            with open(f"{self.folder}/opened", "a") as log:
                log.write(f"{partition}-{epoch}\n")
            return not os.path.exists(self.path)

        def process(self, row):
            self.rows.append(row["id"])
            if row["id"] == 4 and not os.path.exists(f"{self.folder}/failed"):
                open(f"{self.folder}/failed", "w").close()
                raise RuntimeError("visitor fails once")

        def close(self, error):
            if error is None and self.rows:
                with open(self.path, "w") as file:
                    file.write("".join(f"{i}\n" for i in self.rows))

    return Files(folder)


def test_row_visitor_has_a_life_cycle(spark, stream, tmp_path):
    folder = str(tmp_path / "visited")
    os.mkdir(folder)
    checkpoint = str(tmp_path / "checkpoint")
    with pytest.raises(StreamingQueryException):
        start_visitor(stream, file_visitor(folder), checkpoint, interval=None).awaitTermination()
    start_visitor(stream, file_visitor(folder), checkpoint, interval=None).awaitTermination()
    done = [int(line) for path in glob.glob(f"{folder}/*-*") for line in open(path)]
    assert sorted(done) == list(range(9))
    assert len(open(f"{folder}/opened").read().split()) > len(glob.glob(f"{folder}/*-*"))


def test_numbers_go_on_from_batch_to_batch(spark, stream, tmp_path):
    got, failed, checkpoint = {}, [], str(tmp_path / "checkpoint")

    def keep(df, batch):
        got[batch[1]] = [(r["row_id"], r["id"]) for r in df.orderBy("row_id").collect()]
        if batch[1] == 1 and not failed:
            failed.append(1)
            raise RuntimeError("once")

    sinks = [numbered(keep, ledger_folder(checkpoint), order_by="id")]
    with pytest.raises(StreamingQueryException):
        start_fan_out(stream, sinks, checkpoint, interval=None).awaitTermination()
    start_fan_out(stream, sinks, checkpoint, interval=None).awaitTermination()
    assert [n for batch in sorted(got) for n, _ in got[batch]] == list(range(9))
    assert sorted(i for batch in got.values() for _, i in batch) == list(range(9))
    with pytest.raises(ValueError, match="left no count"):
        numbered(keep, str(tmp_path / "other"))(spark.range(1), ("s", 5))


def test_sql_over_each_batch(spark, tmp_path):
    seen = []
    sink = sql_sink("select count(*) as n from batch where id > 1", lambda df, batch: seen.append((batch, df.head()["n"])))
    write = fan_out([sink], "s")
    write(spark.range(5), 0)
    write(spark.range(0), 1)
    assert seen == [(("s", 0), 3), (("s", 1), 0)]
    assert not spark.catalog.tableExists("batch")


def test_first_delivery_compares_rows_after_dealing_them_out(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 7).alias("minutes"))
    path = str(tmp_path / "delivered")
    for parts in (3, 5):
        with_place(rows.repartition(parts)).withColumns({"stream_id": F.lit("s"), "batch_id": F.lit(7)}).write.mode(
            "append").parquet(path)
    kept = first_delivery(spark.read.parquet(path))
    plan = [line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line or "HashAggregate" in line]
    first_exchange = next(i for i, line in enumerate(plan) if "Exchange" in line)
    assert not any("HashAggregate" in line for line in plan[first_exchange:])  # no comparison before the shuffle
    assert kept.count() == 2000
    assert sorted(tuple(r) for r in kept.groupBy("minutes").count().collect()) == [(m, 2000 // 7 + (m < 2000 % 7)) for m in range(7)]


def test_places_of_rows_equal_in_all_columns_need_no_window_over_a_group(spark):
    rows = [(1,)] * 40 + [(2,)] * 3 + [(None,)] * 2
    df = spark.createDataFrame(rows, "minutes int")
    placed = with_place(df.repartition(3))
    assert "Window" not in placed._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["minutes"] is None, r["minutes"] or 0, r["place"]) for r in placed.collect())
    assert len(got) == len(rows) and len({p for *_, p in got}) == len(rows)
    assert sorted(r["place"] for r in with_place(df.repartition(5)).collect()) == sorted(p for *_, p in got)
    assert sorted(int(p.rsplit("-", 1)[1]) for m, v, p in got if not m and v == 1) == list(range(1, 41))
