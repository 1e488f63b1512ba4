import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreflow import plans
from scoreflow.session import scratch_path
from scoreflow.sinks import (
    first_delivery,
    jdbc_rows,
    jdbc_options,
    kafka_records,
    kafka_sink,
    result_jdbc_sink,
    result_rows,
    write_csv,
    write_jdbc,
    write_kafka,
    write_parquet,
    write_table,
    write_text,
)
from scoreflow.sources import (
    kafka_options,
    keyed_bytes,
    keyed_text,
    read_binary,
    read_csv,
    read_images,
    read_lines,
    stream_images,
    stream_kafka,
    stream_lines,
    stream_socket,
)


@pytest.fixture
def scored(spark):
    return spark.createDataFrame([("P1", 3), ("P2", 4), (None, -1)], "PNO string, minutes bigint")


def test_lines_of_either_ending(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"1,2\r\n\r\n3,4\n\n5,6")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ["1,2", "", "3,4", "", "5,6"]
    assert [r.value for r in read_lines(spark, str(tmp_path), blank=False).collect()] == ["1,2", "3,4", "5,6"]


def test_csv_with_and_without_schema(spark, tmp_path):
    (tmp_path / "p.csv").write_text("PNO,AGE\nP1,30\nP2,31\n")
    inferred = read_csv(spark, str(tmp_path))
    assert inferred.dtypes == [("PNO", "string"), ("AGE", "int")]
    given = read_csv(spark, str(tmp_path), schema="PNO string, AGE bigint")
    assert given.dtypes == [("PNO", "string"), ("AGE", "bigint")] and given.count() == 2


def test_kafka_reader_options():
    assert kafka_options("b:9092", "visits", group="g", min_partitions=3, starting="earliest", max_offsets=10) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "visits", "kafka.group.id": "g",
        "minPartitions": "3", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10"}
    assert kafka_options("b:9092", "t") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "latest"}


def test_kafka_frames(spark):
    records = spark.createDataFrame([(b"P1", b"1,2"), (None, b"3,4")], "key binary, value binary")
    assert [tuple(r) for r in keyed_text(records).collect()] == [("P1", "1,2"), (None, "3,4")]
    assert keyed_bytes(records).dtypes == [("key", "string"), ("value", "binary")]


def test_kafka_needs_its_package(spark, scored):
    # The connector is not on this class path; both ends must get as far as asking for it.
    with pytest.raises(Exception, match="kafka"):
        stream_kafka(spark, servers="b:9092", topic="t")
    with pytest.raises(Exception, match="kafka"):
        write_kafka(scored, "b:9092", "t", "minutes")
    with pytest.raises(Exception, match="kafka"):
        kafka_sink("b:9092", "t", "minutes")(scored, ("s", 0))
    with pytest.raises(Exception, match="kafka"):
        plans.publish_minutes("b:9092", "t")(scored, ("s", 0))


def test_kafka_records(scored):
    assert kafka_records(scored, "minutes", "PNO").dtypes == [("key", "string"), ("value", "string")]
    assert kafka_records(scored, F.col("minutes") + 1).first().value == "4"


def test_socket_reader_is_set_up_without_connecting(spark):
    lines = stream_socket(spark, "localhost", 9999)
    assert lines.isStreaming and lines.columns == ["value"]


def test_text_fails_if_the_path_exists(scored, tmp_path):
    path = str(tmp_path / "out")
    write_text(scored, path, "minutes")
    assert sorted(r.value for r in read_lines(scored.sparkSession, path).collect()) == ["-1", "3", "4"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_text(scored, path, "minutes")
    with pytest.raises(ValueError, match="several columns"):
        write_text(scored, path)


def test_csv_and_parquet_append(spark, scored, tmp_path):
    for write, read in ((write_csv, lambda p: spark.read.schema(scored.schema).csv(p)), (write_parquet, spark.read.parquet)):
        path = str(tmp_path / write.__name__)
        write(scored, path)
        write(scored, path)
        assert sorted(map(str, read(path).collect())) == sorted(map(str, scored.collect() * 2))


def test_a_repeated_batch_leaves_one_copy(spark, scored, tmp_path):
    path = str(tmp_path / "out")
    for batch in (("s", 0), ("s", 1), ("s", 1), ("a/b=c %", 0)):
        write_parquet(scored, path, batch=batch)
    got = spark.read.parquet(path).groupBy("stream_id", "batch_id").count().collect()
    assert sorted(map(tuple, got)) == [("a/b=c %", 0, 3), ("s", 0, 3), ("s", 1, 3)]
    for _ in range(2):
        write_csv(scored, str(tmp_path / "csv"), batch=("s", 0))
        write_text(scored, str(tmp_path / "text"), "minutes", batch=("s", 0))
    assert spark.read.csv(str(tmp_path / "csv")).count() == spark.read.text(str(tmp_path / "text")).count() == 3


def test_table_append_and_batches(spark, scored):
    write_table(scored, "plain_result")
    write_table(scored.select("minutes", "PNO"), "plain_result")
    assert spark.table("plain_result").count() == 6
    assert {r.PNO for r in spark.table("plain_result").collect()} == {"P1", "P2", None}
    for batch in (("s", 0), ("s", 1), ("s", 1)):
        write_table(scored, "keyed_result", batch=batch)
    assert spark.table("keyed_result").count() == 6
    write_table(scored, "keyed_result", batch=("it's {odd}", 0))
    assert spark.table("keyed_result").filter("stream_id = \"it's {odd}\"").count() == 3


def test_result_rows(spark, scored):
    rows = result_rows(scored)
    assert rows.columns == ["PNO", "PRETIME", "Time"]
    stamps = {r.Time for r in rows.collect()}
    assert len(stamps) == 1
    fixed = result_rows(scored, stamp=F.lit("2019-09-11 10:20:30").cast("timestamp"))
    assert tuple(fixed.first()) == ("P1", 3, "2019-09-11 10:20:30")


def test_jdbc_call(scored, monkeypatch):
    # No database is started here: what reaches Spark's writer is looked at instead.
    calls = []
    writer = type(scored.write)
    monkeypatch.setattr(writer, "jdbc", lambda self, url, table, mode, properties: calls.append(
        (self._df.columns, url, table, mode, properties)))
    properties = {"user": "u", "password": "p", "driver": "d"}
    write_jdbc(scored, "jdbc:x", "scores", properties)
    result_jdbc_sink("jdbc:x", "result", properties, connections=4)(scored, ("s", 7))
    result_jdbc_sink("jdbc:x", "result", properties, tag_batches=True)(scored, ("s", 7))
    assert calls[0] == (["PNO", "minutes"], "jdbc:x", "scores", "append",
                        {"numPartitions": "8", "batchsize": "10000", **properties})
    assert calls[1][0] == ["PNO", "PRETIME", "Time"] and calls[1][4]["numPartitions"] == "4"
    assert calls[2][0] == ["PNO", "PRETIME", "Time", "stream_id", "batch_id"]
    assert jdbc_options({"batchsize": "1"})["batchsize"] == "1"


def png(width, height, pixels):
    import struct

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = b"".join(b"\0" + pixels[y * width * 3:(y + 1) * width * 3] for y in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    folder = tmp_path / "images"
    folder.mkdir()
    pixels = bytes(range(36))
    (folder / "good.png").write_bytes(png(4, 3, pixels))
    (folder / "bad.png").write_bytes(b"no image")
    got = plans.image_pixels(read_images(spark, str(folder))).collect()
    assert len(got) == 1
    blue_first = b"".join(bytes(pixels[i:i + 3][::-1]) for i in range(0, 36, 3))
    assert (got[0].width, got[0].height, got[0].nChannels, bytes(got[0].data)) == (4, 3, 3, blue_first)

    stream = plans.image_pixels(stream_images(spark, str(folder)))
    query = stream.writeStream.format("memory").queryName("pixels").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [bytes(r.data) for r in spark.table("pixels").collect()] == [blue_first]

    raw = {r.key.rsplit("/", 1)[1]: bytes(r.value) for r in read_binary(spark, str(folder), "*.png").collect()}
    assert raw["bad.png"] == b"no image"


def test_payload_images(spark):
    import numpy as np

    def decode(payload):
        return None if payload[:1] == b"!" else np.frombuffer(payload, np.uint8).reshape(2, -1, 3)

    records = spark.createDataFrame(
        [("a", bytes(range(12))), ("b", b"!"), ("c", None)], "key string, value binary")
    got = plans.decode_images(records, decode).collect()
    assert [(r.key, r.width, r.height, r.nChannels, bytes(r.data)) for r in got] == [("a", 2, 2, 3, bytes(range(12)))]
    plan = plans.decode_images(records, decode)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_limits_of_a_file_stream(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.txt").write_text("12345\n" * 10)
    for limits, expected in (({"max_files": 3}, 2), ({"max_bytes": 60}, 4), ({}, 1)):
        lines = stream_lines(spark, str(tmp_path), **limits)
        query = lines.writeStream.format("noop").trigger(availableNow=True).start()
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == expected, limits


def test_payloads(spark):
    records = spark.createDataFrame([("k", b"a\xffb")], "key string, value binary")
    assert tuple(plans.payload_text(records).first()) == ("k", "ab")
    text = spark.createDataFrame([("k", "é")], "key string, value string")
    assert bytes(plans.payload_bytes(text).first().bytes) == "é".encode()


def test_people_export_needs_two_folders(spark, tmp_path):
    table = plans.people(spark.createDataFrame([("P17,12,33,7,1,54,4,2,1260",)], "value string"))
    with pytest.raises(ValueError, match="different folders"):
        plans.export_people(table, f"{tmp_path}/x", f"{tmp_path}/x/")
    plans.export_people(table, f"{tmp_path}/csv", f"{tmp_path}/parquet")
    assert read_lines(spark, f"{tmp_path}/csv").first().value == "P17,12,33,7,1,54,4,2,1260"
    query = plans.query_people(spark.read.parquet(f"{tmp_path}/parquet"))
    assert [tuple(r) for r in query.collect()] == [("P17", 1260)]
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(AGE,20)" in plan and "EqualTo(IO,2)" in plan
    assert "ReadSchema: struct<PNO:string,AGE:bigint,IO:bigint,SECOND:bigint>" in plan


def test_scratch_lies_in_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base + "/") and first != second


def test_scratch_without_a_named_folder():
    import os
    from types import SimpleNamespace

    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master=master))

    assert os.path.isdir(os.path.dirname(os.path.dirname(scratch_path(session("local[2]"), "x"))))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn"), "x")


def test_jdbc_rows_are_dealt_out_before_the_writer(spark):
    rows = jdbc_rows(spark.range(100).repartition(20), 3, ("s", 7))
    assert rows.rdd.getNumPartitions() == 3 and rows.columns == ["id", "stream_id", "batch_id"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 3, true" in plan and "Repartition 20, true" not in plan.split("Range")[0].split("Repartition 3")[0]
    repeated = rows.union(rows).union(jdbc_rows(spark.range(5), 3, ("s", 8)))
    assert first_delivery(repeated).count() == 105


def test_sixteen_bit_pixels_stay_whole(spark):
    pixels = {b"a": np.array([[300, 65535]], np.uint16), b"b": np.zeros((2, 1, 3), np.uint8), b"c": None}
    records = spark.createDataFrame([("x", b"a"), ("y", b"b"), ("z", b"c"), ("n", None)], "key string, value binary")
    got = {r.key: r for r in plans.decode_images(records, lambda data: pixels[bytes(data)]).collect()}
    assert set(got) == {"x", "y"}
    assert got["x"].dtype == "uint16" and np.frombuffer(got["x"].data, "<u2").tolist() == [300, 65535]
    assert (got["y"].width, got["y"].height, got["y"].nChannels, got["y"].dtype) == (1, 2, 3, "uint8")
