import pytest
from pyspark.sql import functions as F

from scoreflow import plans
from scoreflow.catalog import feeds
from scoreflow.catalog.feeds import BOOST3, FOREST4
from scoreflow.functions import minutes_message
from scoreflow.operators import keep_int_field, run_sql
from scoreflow.sinks import (
    console_sink,
    csv_sink,
    fitting,
    key_minutes_sink,
    parquet_sink,
    partition_sink,
    rejects_sink,
    result_table_sink,
    text_sink,
)
from scoreflow.sources import read_lines, stream_lines, stream_parquet, stream_table
from scoreflow.streaming import start_console, start_fan_out, start_files, start_table, start_visitor


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return feeds.table(spark, sf_dir, "orders").limit(300).repartition(5).cache()


@pytest.fixture
def keyed(spark, orders, tmp_path):
    """Five files of keyed records, one per micro-batch."""
    path = str(tmp_path / "keyed")
    records = feeds.keyed7_records(orders)
    records.write.parquet(path)
    return lambda: stream_parquet(spark, path, records.schema, max_files=1)


def batches(query):
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_stream_equals_batch(spark, orders, tmp_path):
    source = str(tmp_path / "lines")
    keep_int_field(feeds.mri11_lines(orders)).select("value").write.text(source)
    scored = plans.score_stream(stream_lines(spark, source, max_files=1), FOREST4)
    out = str(tmp_path / "out")
    query = start_files(scored, "parquet", out, str(tmp_path / "checkpoint"), interval=None)
    assert len(batches(query)) == 5
    batch = plans.score_lines(read_lines(spark, source), FOREST4, checked=None)
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())


def test_fan_out_scores_once_and_feeds_all_sinks(spark, orders, keyed, tmp_path, capsys):
    scored = plans.score_keyed_stream(keyed(), BOOST3)
    paths = {n: str(tmp_path / n) for n in ("topic", "file", "csv", "parquet", "visits", "checkpoint")}
    (tmp_path / "visits").mkdir()
    visits = paths["visits"]

    def visit(parts):
        import uuid

        for part in parts:
            with open(f"{visits}/{uuid.uuid4().hex}", "w") as out:
                out.write(str(len(part)))

    pno, minutes = F.col("PNO"), F.col("minutes")
    sinks = [result_table_sink("fan_result"), text_sink(paths["topic"], minutes_message(pno, minutes)),
             key_minutes_sink(paths["file"]), csv_sink(paths["csv"]), parquet_sink(paths["parquet"]),
             partition_sink(visit), console_sink(2)]
    assert len(batches(start_fan_out(scored, sinks, paths["checkpoint"], interval=None))) == 5

    batch = plans.score_keyed_stream(feeds.keyed7_records(orders), BOOST3).collect()
    expected = sorted((r.PNO, r.minutes) for r in batch)
    table = spark.table("fan_result")
    assert sorted((r.PNO, r.PRETIME) for r in table.collect()) == expected
    assert table.select("stream_id").distinct().count() == 1
    assert table.select("batch_id").distinct().count() == 5
    lines = sorted(r.value for r in spark.read.text(paths["file"]).select("value").collect())
    assert lines == sorted(f"{p},{m}" for p, m in expected)
    messages = {r.value for r in spark.read.text(paths["topic"]).select("value").collect()}
    assert messages == {f"The Patient NO. is {p}, need {m} minutes to detect by MRI" for p, m in expected}
    assert spark.read.csv(paths["csv"]).count() == spark.read.parquet(paths["parquet"]).count() == len(expected)
    assert sum(int(p.read_text()) for p in (tmp_path / "visits").iterdir()) == len(expected)
    assert "Batch: 4" in capsys.readouterr().out
    assert not spark.sparkContext._jsc.getPersistentRDDs() or orders.is_cached


def test_failed_batch_runs_again_under_its_id(spark, orders, keyed, tmp_path):
    scored = plans.score_keyed_stream(keyed(), BOOST3)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    seen, failed = [], []

    def fail_once(df, batch):
        seen.append(batch)
        if batch[1] == 2 and not failed:
            failed.append(batch)
            raise RuntimeError("sink is down")

    sinks = [parquet_sink(out), fail_once]
    with pytest.raises(Exception, match="sink is down"):
        start_fan_out(scored, sinks, checkpoint, interval=None).awaitTermination()
    for _ in range(2):
        start_fan_out(scored, sinks, checkpoint, interval=None).awaitTermination()
    assert [i for _, i in seen] == [0, 1, 2, 2, 3, 4]
    assert len({s for s, _ in seen}) == 1
    assert spark.read.parquet(out).count() == orders.count()


def test_streams_with_other_checkpoints_do_not_replace_each_other(spark, orders, keyed, tmp_path):
    out = str(tmp_path / "out")
    for i in range(2):
        scored = plans.score_keyed_stream(keyed(), BOOST3)
        start_fan_out(scored, [parquet_sink(out)], str(tmp_path / f"c{i}"), interval=None).awaitTermination()
    assert spark.read.parquet(out).count() == 2 * orders.count()


def test_appending_sinks(spark, orders, keyed, tmp_path):
    out = str(tmp_path / "out")
    scored = plans.score_keyed_stream(keyed(), BOOST3)
    sinks = [parquet_sink(out, keyed=False), result_table_sink("appended", keyed=False)]
    start_fan_out(scored, sinks, str(tmp_path / "c"), interval=None, stream_id="mine").awaitTermination()
    assert spark.read.parquet(out).columns == ["PNO", "prediction", "seconds", "minutes"]
    assert spark.table("appended").count() == orders.count()


def test_table_console_and_visitor(spark, orders, keyed, tmp_path):
    scored = plans.score_keyed_stream(keyed(), BOOST3).select("PNO", "minutes")
    start_table(scored, "streamed", str(tmp_path / "c1"), interval=None).awaitTermination()
    assert spark.table("streamed").count() == orders.count()
    start_console(scored, str(tmp_path / "c2"), interval=None, rows=1).awaitTermination()
    folder = tmp_path / "visits"
    folder.mkdir()
    target = str(folder)

    def visit(row):
        with open(f"{target}/{row.PNO}", "w") as out:
            out.write(str(row.minutes))

    start_visitor(scored, visit, str(tmp_path / "c3"), interval=None).awaitTermination()
    assert len(list(folder.iterdir())) == orders.count()


def test_interval_runs_until_stopped(spark, keyed, tmp_path):
    scored = plans.score_keyed_stream(keyed(), BOOST3)
    query = start_files(scored, "parquet", str(tmp_path / "out"), str(tmp_path / "c"), interval="1 second", name="ticks")
    try:
        assert query.isActive and query.name == "ticks"
        query.processAllAvailable()
    finally:
        query.stop()


def test_sql_over_a_stream(spark, orders, keyed, tmp_path):
    pairs = run_sql("select PNO, usetime from input_rows", {"input_rows": plans.named_pairs(keyed())})
    assert pairs.isStreaming
    start_files(pairs, "parquet", str(tmp_path / "out"), str(tmp_path / "c"), interval=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == orders.count()


def test_a_bad_record_goes_to_the_rejects_and_the_stream_goes_on(spark, orders, tmp_path):
    source, good, bad, checkpoint = (str(tmp_path / p) for p in ("in", "good", "bad", "checkpoint"))
    records = feeds.keyed7_records(orders)
    records.limit(20).write.mode("append").parquet(source)

    def run():
        stream = stream_parquet(spark, source, records.schema, max_files=1)
        scored = plans.score_keyed_with_rejects(stream, BOOST3)
        sinks = [fitting(key_minutes_sink(good)), rejects_sink(bad, ["PNO", "line"])]
        start_fan_out(scored, sinks, checkpoint, interval=None).awaitTermination()

    run()
    spark.createDataFrame([("P-1", "1,2"), ("P-2", "1,2,3,4,5,6,seven")], records.schema).write.mode("append").parquet(source)
    run()
    records.limit(5).write.mode("append").parquet(source)
    run()
    assert spark.read.text(good).count() == 25
    rejected = {(r.PNO, r.line, r.reason) for r in spark.read.parquet(bad).collect()}
    assert {r[:2] for r in rejected} == {("P-1", "1,2"), ("P-2", "1,2,3,4,5,6,seven")}
    assert {r[2] for r in rejected} == {"short", f"field {BOOST3.features[-1]}"}


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_streams_as_file_and_as_folder(spark, tmp_path, parts):
    folder, checkpoint, out = (str(tmp_path / p) for p in ("t.parquet", "checkpoint", "out"))
    spark.range(90).repartition(parts).write.parquet(folder)
    path = folder
    if parts == 1:
        path = next(str(p) for p in (tmp_path / "t.parquet").glob("part-*.parquet"))
    start_files(stream_table(spark, path, "id bigint"), "parquet", out, checkpoint, interval=None).awaitTermination()
    assert spark.read.parquet(out).count() == 90
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stream_table(spark, str(tmp_path / "absent"), "id bigint")
