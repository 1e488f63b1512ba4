"""Command line of the jobs, for spark-submit.

    spark-submit submit.py batch-score --input IN --model forest.json --output OUT
    spark-submit submit.py keyed-stream --servers b:9092 --topic visits ...
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoreflow import fixed_values as fixed, plans
from scoreflow.functions import seconds_line, seconds_message
from scoreflow.layouts import LAYOUTS
from scoreflow.models import TreeEnsemble
from scoreflow.operators import preview
from scoreflow.session import build_session
from scoreflow.sinks import (
    Sink,
    console_sink,
    fitting,
    kafka_sink,
    key_minutes_sink,
    rejects_sink,
    result_jdbc_sink,
    result_table_sink,
    text_sink,
    write_text,
)
from scoreflow.sources import (
    read_csv,
    read_lines,
    stream_images,
    stream_kafka,
    stream_kafka_binary,
    stream_lines,
    stream_socket,
)
from scoreflow.streaming import start_console, start_fan_out


# Bounds of a micro-batch unless others are given: what a failed one has to do again.
MAX_BATCH_BYTES = 8 << 30
MAX_BATCH_OFFSETS = 10_000_000


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(spark or build_session(f"scoreflow {args.job}"), args)


def batch_score(spark: SparkSession, args) -> None:
    lines = read_lines(spark, args.input)
    model, layout = _model(spark, args), LAYOUTS[args.layout]
    if args.indexed:
        scored = plans.score_indexed_lines(lines, model, layout, args.policy)
        line = F.format_string("(%s, %s)", "row_id", "prediction")
    else:
        scored = plans.score_lines(lines, model, layout, args.checked, args.policy, args.short_rows)
        line = F.col("prediction")
    if args.output:
        write_text(scored, args.output, line)
    else:
        preview(scored.select("row_id", "prediction") if args.indexed else scored, args.rows).show(args.rows)


def line_stream(spark: SparkSession, args) -> None:
    """Unkeyed lines: predictions to the console, and to a topic or file if named."""
    scored = plans.score_stream(
        _stream(spark, args), _model(spark, args), LAYOUTS[args.layout], args.policy, args.checked
    )
    sinks: list[Sink] = []
    if args.publish_topic:
        sinks.append(kafka_sink(args.publish_servers or args.servers, args.publish_topic,
                                seconds_message(F.col("prediction"))))
    if args.file:
        sinks.append(text_sink(args.file, seconds_line(F.col("prediction")), not args.append))
    _run(scored, sinks, args)


def keyed_stream(spark: SparkSession, args) -> None:
    """Keyed records: minutes to a table or database, a topic, a file, the console."""
    layout, sinks = LAYOUTS[args.layout], []
    if args.rejects:
        scored = plans.score_keyed_with_rejects(_stream(spark, args), _model(spark, args), layout)
    else:
        scored = plans.score_keyed_stream(_stream(spark, args), _model(spark, args), layout, args.policy)
    if args.result_table:
        sinks.append(result_table_sink(args.result_table, keyed=not args.append))
    if args.jdbc_url:
        with open(args.jdbc_properties) as file:
            sinks.append(result_jdbc_sink(
                args.jdbc_url, args.jdbc_table, json.load(file), tag_batches=args.tag_batches))
    if args.publish_topic:
        sinks.append(plans.publish_minutes(args.publish_servers or args.servers, args.publish_topic))
    if args.file:
        sinks.append(key_minutes_sink(args.file, keyed=not args.append))
    if args.rejects:
        if args.console or not sinks:
            sinks.append(console_sink())
        sinks = [*map(fitting, sinks), rejects_sink(args.rejects, ["PNO", "line"])]
        args.console = False
    _run(scored, sinks, args)


def people_sql(spark: SparkSession, args) -> None:
    if args.csv:
        table = read_csv(spark, args.input)
    else:
        table = plans.people(read_lines(spark, args.input))
    table.printSchema()
    plans.query_people(table, args.query).show(args.rows)
    if args.csv_output and args.parquet_output:
        plans.export_people(table, args.csv_output, args.parquet_output)


def payload_stream(spark: SparkSession, args) -> None:
    """Bytes of a topic as clean text, or images of a folder as pixels, on the console."""
    if args.images:
        rows = plans.image_pixels(stream_images(spark, args.images, **_file_limits(args)))
    else:
        rows = plans.payload_text(stream_kafka_binary(
            spark, servers=args.servers, topic=args.topic, group=args.group, starting=args.starting,
            max_offsets=args.max_offsets))
    start_console(rows, args.checkpoint, args.interval).awaitTermination()


def _model(spark: SparkSession, args):
    if args.model_loader:
        module, function = args.model_loader.split(":")
        return getattr(importlib.import_module(module), function)(args.model)
    return args.model if args.mllib else TreeEnsemble.load(spark, args.model)


def _stream(spark: SparkSession, args) -> DataFrame:
    if args.socket:
        host, port = args.socket.rsplit(":", 1)
        return stream_socket(spark, host, int(port))
    if args.folder:
        # Lines of `key<tab>value`, or values alone.
        lines = stream_lines(spark, args.folder, **_file_limits(args))
        parts = F.split("value", "\t", 2)
        return lines.select(
            F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).alias("key"),
            F.element_at(parts, -1).alias("value"),
        )
    return stream_kafka(spark, servers=args.servers, topic=args.topic, group=args.group,
                        min_partitions=args.min_partitions, starting=args.starting, max_offsets=args.max_offsets)


def _file_limits(args) -> dict[str, int]:
    # Spark takes one of the two.
    return {"max_files": args.max_files} if args.max_files else {"max_bytes": args.max_bytes}


def _run(scored: DataFrame, sinks: list[Sink], args) -> None:
    if args.console or not sinks:
        sinks.append(console_sink())
    start_fan_out(scored, sinks, args.checkpoint, args.interval).awaitTermination()


def _interval(text: str) -> str | None:
    return None if text == "once" else text


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="submit.py", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, run, layout: str | None = None) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=(run.__doc__ or name).splitlines()[0])
        sub.set_defaults(run=run)
        if layout:
            sub.add_argument("--model", required=True, help="JSON tree ensemble; see also the next two")
            sub.add_argument("--mllib", action="store_true", help="the model is the folder of an MLlib pipeline")
            sub.add_argument("--model-loader", help="module:function that turns --model into an object with predict")
            sub.add_argument("--layout", choices=sorted(LAYOUTS), default=layout)
            sub.add_argument("--policy", choices=("strict", "drop", "null"), default="strict")
        return sub

    def streaming(sub: argparse.ArgumentParser, interval: str) -> None:
        sub.add_argument("--servers", help="Kafka brokers")
        sub.add_argument("--topic")
        sub.add_argument("--group", help="consumer group")
        sub.add_argument("--min-partitions", type=int)
        sub.add_argument("--starting", default="latest", help="earliest, latest or offsets as JSON")
        sub.add_argument("--max-files", type=int, help="files of a folder in one micro-batch")
        sub.add_argument("--max-bytes", type=int, default=MAX_BATCH_BYTES, help="input of a folder in one micro-batch")
        sub.add_argument("--max-offsets", type=int, default=MAX_BATCH_OFFSETS, help="records of a topic in one micro-batch")
        sub.add_argument("--checkpoint", required=True, help="folder on shared storage")
        sub.add_argument("--interval", type=_interval, default=interval, help="a time, or `once` to stop when done")

    def outputs(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--socket", help="host:port to read lines from")
        sub.add_argument("--folder", help="folder to read text files from")
        sub.add_argument("--publish-topic")
        sub.add_argument("--publish-servers", help="brokers of that topic, if others")
        sub.add_argument("--file", help="folder for lines")
        sub.add_argument("--append", action="store_true", help="no partition per batch; a repeated batch is written twice")
        sub.add_argument("--console", action="store_true")

    batch = job("batch-score", batch_score, "mri11")
    batch.add_argument("--input", required=True)
    batch.add_argument("--output", help="folder that must not exist; without it the first rows are shown")
    batch.add_argument("--indexed", action="store_true", help="number the rows")
    batch.add_argument("--checked", type=int, default=fixed.CHECKED_FIELD)
    batch.add_argument("--short-rows", choices=("drop", "fail"), default="drop")
    batch.add_argument("--rows", type=int, default=5)

    line = job("line-stream", line_stream, "mri11")
    line.add_argument("--checked", type=int, help="keep lines whose field at this position is a whole number")
    streaming(line, fixed.SOCKET_INTERVAL)
    outputs(line)

    keyed = job("keyed-stream", keyed_stream, "keyed7")
    streaming(keyed, fixed.KAFKA_INTERVAL)
    outputs(keyed)
    keyed.add_argument("--result-table", help="catalog table for (PNO, PRETIME, Time)")
    keyed.add_argument("--jdbc-url")
    keyed.add_argument("--jdbc-table", default="result")
    keyed.add_argument("--tag-batches", action="store_true",
                       help="write the batch of each row to the database, so that readers can drop repeats")
    keyed.add_argument("--rejects", help="folder for records that cannot be read; they then stop nothing")
    keyed.add_argument("--jdbc-properties", help="JSON file with user, password and driver")

    people = job("people-sql", people_sql)
    people.add_argument("--input", required=True)
    people.add_argument("--csv", action="store_true", help="CSV with a header and inferred types")
    people.add_argument("--query", default=fixed.PEOPLE_QUERY)
    people.add_argument("--rows", type=int, default=20)
    people.add_argument("--csv-output")
    people.add_argument("--parquet-output")

    payload = job("payload-stream", payload_stream)
    streaming(payload, fixed.IMAGE_INTERVAL)
    payload.add_argument("--images", help="folder of image files")
    return parser
