"""Registered queries: one callable (spark, sf_dir) -> DataFrame per name.

Each reads whole tables. Where a job works on files or streams, Spark first
writes the feed it needs from a table to the shared scratch folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from scoreflow import plans
from scoreflow.catalog import feeds
from scoreflow.catalog.feeds import BOOST3, BOOST8, BOOST_IMPORTED, FOREST4, table
from scoreflow.catalog.images import (
    decode_map,
    gather_image_tasks,
    page_of,
    page_payloads,
    page_pixels,
    write_page_images,
)
from scoreflow.fixed_values import CHECKED_FIELD
from scoreflow.functions import (
    int_vector,
    key_minutes_line,
    minutes_message,
    seconds_line,
    seconds_message,
    truncate,
    zip_rows,
)
from scoreflow.layouts import KAFKA8, KEYED7, MRI11, FieldLayout
from scoreflow.models import TreeEnsemble, broadcast_model
from scoreflow.operators import (
    ObservedError,
    cast_columns,
    distribute,
    keep_int_field,
    map_batches,
    mape,
    parse_delimited,
    parse_with_rejects,
    preview,
    register_view,
    score_mllib,
    score_python,
    score_trees,
    with_dense_index,
    with_minutes,
    with_observed_error,
    with_seconds,
)
from scoreflow.session import scratch_path
from scoreflow.sinks import (
    each_once,
    first_delivery,
    key_minutes_sink,
    parquet_sink,
    result_rows,
    result_table_sink,
    text_sink,
    with_message_id,
    with_place,
    write_csv,
    write_parquet,
    write_table,
    write_text,
)
from scoreflow.sources import (
    keyed_bytes,
    keyed_text,
    read_csv,
    read_images,
    read_lines,
    stream_images,
    stream_lines,
    stream_parquet,
    stream_table,
)
from scoreflow.streaming import ledger_folder, numbered, sql_sink, start_fan_out, start_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A replay of any size runs in micro-batches of at most this much input.
REPLAY_BYTES = 8 << 30

# Rows that the MLlib models are fitted to, at most; all rows are scored.
FIT_ROWS = 20_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.mri11_lines(_orders(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_delimited(_lines(spark, sf_dir), MRI11, "drop", keep=["PNO"])


def _keyed_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.score_keyed_stream(feeds.keyed7_records(_orders(spark, sf_dir)), BOOST3)


# Scans


@query
def text_scan_nonblank(spark, sf_dir):
    """Lines with both line ends and blank lines in between, read without the blank ones."""
    k, line = F.col("k"), F.col("value")
    line = F.when(k % 2 == 0, F.concat(line, F.lit("\r"))).otherwise(line)
    line = F.when(k % 89 == 0, F.concat(line, F.lit("\n"))).otherwise(line)
    path = feeds.write_lines(_lines(spark, sf_dir).select(line.alias("value")), "text-scan")
    return read_lines(spark, path, blank=False)


@query
def csv_header_inferred(spark, sf_dir):
    path = scratch_path(spark, "people-csv")
    write_csv(feeds.people_table(_orders(spark, sf_dir)), path, header=True)
    return read_csv(spark, path)


# Filters and parsing


@query
def filter_int_field(spark, sf_dir):
    return keep_int_field(_lines(spark, sf_dir)).select("PNO", "value")


@query
def parse_mri11(spark, sf_dir):
    return _parsed(spark, sf_dir)


@query
def parse_rejects(spark, sf_dir):
    """The lines that do not fit, each with its reason."""
    rows = parse_with_rejects(_lines(spark, sf_dir), MRI11, keep=["PNO"])
    return rows.filter("reason IS NOT NULL").select("PNO", "line", "reason")


@query
def parse_mri11_nulls(spark, sf_dir):
    return parse_delimited(_lines(spark, sf_dir), MRI11, "null", keep=["PNO"])


@query
def parse_kafka8(spark, sf_dir):
    records = feeds.kafka8_records(_orders(spark, sf_dir))
    return parse_delimited(records.select("value"), KAFKA8)


@query
def parse_keyed7_truncate(spark, sf_dir):
    rows = parse_delimited(feeds.keyed7_records(_orders(spark, sf_dir)), KEYED7, keep=["key"])
    return rows.select(
        F.col("key").alias("PNO"), *[truncate(F.col(c)).alias(c) for c in KEYED7.columns]
    )


@query
def cast_int_columns(spark, sf_dir):
    text = FieldLayout.of("mri11_text", MRI11.columns, "string")
    rows = parse_delimited(keep_int_field(_lines(spark, sf_dir)), text, keep=["PNO"])
    return cast_columns(rows, MRI11.columns)


@query
def vector_assemble(spark, sf_dir):
    rows = feeds.features(_orders(spark, sf_dir))
    vector = rows.select("PNO", int_vector(MRI11.columns).alias("v"))
    return vector.select("PNO", *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(len(MRI11.columns))])


@query
def zip_arrays(spark, sf_dir):
    rows = feeds.features(_orders(spark, sf_dir))
    positions = F.sequence(F.lit(0).cast("bigint"), F.lit(len(MRI11.columns) - 1).cast("bigint"))
    values = int_vector(MRI11.columns).cast("array<double>")
    return rows.select("PNO", zip_rows(positions, values, "position", "field_value"))


# SQL


@query
def people_sql(spark, sf_dir):
    path = feeds.write_lines(feeds.people_lines(_orders(spark, sf_dir)), "people-lines")
    return plans.query_people(plans.people(read_lines(spark, path)))


@query
def people_sql_parquet(spark, sf_dir):
    csv_path, parquet_path = scratch_path(spark, "people-csv"), scratch_path(spark, "people-parquet")
    people = plans.people(feeds.people_lines(_orders(spark, sf_dir)))
    plans.export_people(people, csv_path, parquet_path)
    text = "select PNO, SECOND from people where AGE > :age and IO = :io"
    return plans.query_people(spark.read.parquet(parquet_path), text, age=20, io=2)


# Row identity


@query
def dense_index(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    # The key is the table's own: unique, and cheap to read twice.
    return with_dense_index(orders, order_by="o_orderkey", spread_ties=False)


@query
def dense_index_partition_order(spark, sf_dir):
    """Numbers in the order of eleven partitions: which row gets which is open, that each comes once is not."""
    orders = _orders(spark, sf_dir).select("o_orderkey")
    indexed = with_dense_index(distribute(orders, 11))
    uses = indexed.groupBy("row_id").agg(F.count(F.lit(1)).alias("uses"), F.max("o_orderkey").alias("key"))
    return uses.agg(
        F.sum("uses").alias("n_rows"),
        F.min("row_id").alias("first_id"),
        F.max("row_id").alias("last_id"),
        F.count_if(F.col("uses") > 1).alias("repeated_ids"),
        F.count_distinct("key").alias("n_keys"),
    )


@query
def dense_index_hot_key(spark, sf_dir):
    """Ordered by a column with three values: ties are numbered too, and split over tasks.

    Which of two equal rows comes first is open, so the answer is the range of
    numbers per value and how many numbers are used more than once.
    """
    orders = _orders(spark, sf_dir).select("o_orderstatus")
    indexed = with_dense_index(orders, order_by="o_orderstatus")
    uses = indexed.groupBy("row_id").agg(F.count(F.lit(1)).alias("uses"), F.min("o_orderstatus").alias("o_orderstatus"))
    return uses.groupBy("o_orderstatus").agg(
        F.min("row_id").alias("first_id"),
        F.max("row_id").alias("last_id"),
        F.sum("uses").alias("n_rows"),
        F.count_if(F.col("uses") > 1).alias("repeated_ids"),
    )


# Scoring


@query
def score_column(spark, sf_dir):
    rows = plans.score_lines(
        _lines(spark, sf_dir), FOREST4, checked=CHECKED_FIELD, policy="strict", keep=["PNO"]
    )
    return rows.select("PNO", "prediction")


@query
def score_python_broadcast(spark, sf_dir):
    scored = score_python(_parsed(spark, sf_dir), FOREST4, MRI11.columns)
    return scored.select("PNO", "prediction")


@query
def score_trees_large(spark, sf_dir):
    """A forest of usual size, in Arrow batches."""
    scored = score_trees(_parsed(spark, sf_dir), feeds.large_forest(), form="arrow")
    return scored.select("PNO", "prediction")


@query
def score_trees_masks(spark, sf_dir):
    """The same forest as bit masks, without Python workers."""
    scored = score_trees(_parsed(spark, sf_dir), feeds.large_forest(), form="masks")
    return scored.select("PNO", "prediction")


@query
def score_flat_forest(spark, sf_dir):
    """A forest from flat arrays of nodes, over values at the edges of single precision."""
    rows = feeds.edge_features(_orders(spark, sf_dir))
    masks = score_trees(rows, feeds.FLAT_FOREST, name="by_masks", form="masks")
    return score_trees(masks, feeds.FLAT_FOREST).select("PNO", "prediction", "by_masks")


@query
def score_boosted_import(spark, sf_dir):
    """A trainer's dump over records with missing fields, in single precision."""
    rows = parse_delimited(_lines(spark, sf_dir), MRI11, "null", keep=["PNO"])
    scored = with_minutes(with_seconds(score_trees(rows, BOOST_IMPORTED)))
    return scored.select("PNO", "prediction", "seconds", "minutes")


@query
def score_batches(spark, sf_dir):
    """Whole batches through a function, key and prediction zipped again."""
    shared = broadcast_model(spark, FOREST4)

    def run(batch):
        model = shared.value
        return batch[["PNO"]].assign(prediction=model.predict(batch[model.features].to_numpy()))

    columns = ["PNO", *FOREST4.features]
    return map_batches(_parsed(spark, sf_dir), run, "PNO string, prediction double", columns)


@query
def score_indexed(spark, sf_dir):
    return plans.score_indexed_lines(
        _lines(spark, sf_dir), FOREST4, policy="drop", order_by="k", keep=["k"], spread_ties=False
    )


@query
def score_keyed_minutes(spark, sf_dir):
    return _keyed_scored(spark, sf_dir)


def _fitted(spark, sf_dir, regressor) -> DataFrame:
    """Fit to some rows, save, load by path and score all rows; the same trees are also scored on their own.

    `agrees` is 1 where both answers are equal, so a wrong tree, weight or average shows in most rows.
    """
    rows = _parsed(spark, sf_dir)
    label = F.col("IO_n") * 300 + F.col("SEX_n") * 60 + F.col("AGE") * F.col("POS_n") + F.col("ITEM_n")
    assembler = VectorAssembler(inputCols=MRI11.columns, outputCol="features")
    path = scratch_path(spark, "mllib-model")
    Pipeline(stages=[assembler, regressor]).fit(rows.withColumn("label", label).limit(FIT_ROWS)).save(path)
    fitted = PipelineModel.load(path).stages[-1]
    own = TreeEnsemble.from_mllib(fitted, MRI11.columns)
    if len({str(tree) for tree in own.trees}) < len(own.trees):
        raise ValueError("some trees are the same, which would hide mistakes")
    both = score_trees(score_mllib(rows, path), own, name="own")
    same = F.abs(F.col("prediction") - F.col("own")) <= 1e-9 * F.abs(F.col("own"))
    return both.select("PNO", F.when(same, 1).otherwise(0).alias("agrees"))


@query
def score_mllib_forest(spark, sf_dir):
    return _fitted(spark, sf_dir, RandomForestRegressor(
        numTrees=4, maxDepth=5, subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=7))


@query
def score_mllib_boosted(spark, sf_dir):
    return _fitted(spark, sf_dir, GBTRegressor(maxIter=3, maxDepth=4, stepSize=0.3, seed=7))


@query
def mape_(spark, sf_dir):
    rows = feeds.features(_orders(spark, sf_dir)).withColumn("SECOND", 60 + F.col("k") % 3600)
    error = mape(score_trees(rows, FOREST4), "SECOND", "prediction")
    return error.select(F.round("mape", 6).alias("mape"))


# Sinks


def _batch_minutes(spark, sf_dir, some: str = "true") -> DataFrame:
    scored = plans.score_lines(_lines(spark, sf_dir).filter(some), FOREST4, keep=["PNO"])
    return with_minutes(with_seconds(scored)).select("PNO", "prediction", "seconds", "minutes")


@query
def sink_text_roundtrip(spark, sf_dir):
    """The batch job from text file to text file, one prediction per line."""
    source, target = feeds.write_lines(_lines(spark, sf_dir), "batch-lines"), scratch_path(spark, "predictions")
    write_text(plans.score_lines(read_lines(spark, source), FOREST4), target, "prediction")
    return read_lines(spark, target).select(F.col("value").cast("double").alias("prediction"))


@query
def sink_csv_roundtrip(spark, sf_dir):
    path, rows = scratch_path(spark, "scored-csv"), _batch_minutes(spark, sf_dir)
    write_csv(rows, path)
    return read_csv(spark, path, schema=rows.schema, header=False)


@query
def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "scored-parquet")
    write_parquet(_batch_minutes(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def sink_table_roundtrip(spark, sf_dir):
    """Two appends to a table kept in the catalog, halves by a key of the input."""
    name, path = f"result_{uuid.uuid4().hex}", scratch_path(spark, "result-table")
    for half in ("k % 2 = 0", "k % 2 = 1"):
        write_table(result_rows(_batch_minutes(spark, sf_dir, half)).select("PNO", "PRETIME"), name, path)
    return spark.table(name)


@query
def result_table_rows(spark, sf_dir):
    """Rows for the SQL table, stamped with the order's time in place of the clock."""
    records = feeds.keyed7_records(_orders(spark, sf_dir), keep=["o_orderdate"])
    scored = plans.score_keyed_stream(records, BOOST3, keep=["o_orderdate"])
    return result_rows(scored, stamp=F.col("o_orderdate"))


@query
def message_minutes(spark, sf_dir):
    rows = _keyed_scored(spark, sf_dir)
    return rows.select("PNO", minutes_message(F.col("PNO"), F.col("minutes")).alias("message"))


@query
def message_seconds(spark, sf_dir):
    rows = _keyed_scored(spark, sf_dir)
    return rows.select(
        "PNO",
        seconds_message(F.col("prediction")).alias("message"),
        seconds_line(F.col("prediction")).alias("line"),
    )


@query
def message_line(spark, sf_dir):
    rows = _keyed_scored(spark, sf_dir)
    return rows.select(key_minutes_line(F.col("PNO"), F.col("minutes")).alias("line"))


@query
def preview_(spark, sf_dir):
    rows = _batch_minutes(spark, sf_dir)
    return preview(rows, 20, [F.desc("prediction"), F.asc("PNO")])


# Streams


@query
def stream_score_replay(spark, sf_dir):
    """Lines from a folder, scored as a stream into text files."""
    source = feeds.write_lines(_lines(spark, sf_dir), "stream-lines")
    target, checkpoint = scratch_path(spark, "stream-text"), scratch_path(spark, "stream-checkpoint")
    lines = stream_lines(spark, source, max_bytes=REPLAY_BYTES)
    scored = plans.score_stream(lines, FOREST4, checked=CHECKED_FIELD)
    predictions = scored.select(F.col("prediction").cast("string").alias("value"))
    start_files(predictions, "text", target, checkpoint, interval=None).awaitTermination()
    return read_lines(spark, target).select(F.col("value").cast("double").alias("prediction"))


@query
def stream_kafka8_seconds(spark, sf_dir):
    """Eight-field records scored in Python on a stream, as sentences."""
    source = scratch_path(spark, "kafka8")
    records = feeds.kafka8_records(_orders(spark, sf_dir))
    write_parquet(records, source)
    stream = stream_parquet(spark, source, records.schema, max_bytes=REPLAY_BYTES)
    rows = parse_delimited(stream, KAFKA8, keep=["key"])
    scored = score_python(rows, BOOST8, KAFKA8.columns)
    out = scored.select(
        F.col("key").alias("PNO"), "prediction", seconds_message(F.col("prediction")).alias("message")
    )
    target, checkpoint = scratch_path(spark, "kafka8-out"), scratch_path(spark, "stream-checkpoint")
    start_files(out, "parquet", target, checkpoint, interval=None).awaitTermination()
    return spark.read.schema(out.schema).parquet(target)


@query
def stream_fan_out(spark, sf_dir):
    """Keyed records scored once and fed to three sinks; what each one got."""
    source = scratch_path(spark, "keyed7")
    records = feeds.keyed7_records(_orders(spark, sf_dir))
    write_parquet(records, source)
    scored = plans.score_keyed_stream(stream_parquet(spark, source, records.schema, max_bytes=REPLAY_BYTES), BOOST3)
    name = f"result_{uuid.uuid4().hex}"
    table_path, topic, file, checkpoint = (
        scratch_path(spark, label) for label in ("fan-table", "fan-topic", "fan-file", "stream-checkpoint")
    )
    pno, minutes = F.col("PNO"), F.col("minutes")
    sinks = [
        result_table_sink(name, table_path),
        text_sink(topic, minutes_message(pno, minutes)),
        key_minutes_sink(file),
    ]
    start_fan_out(scored, sinks, checkpoint, interval=None).awaitTermination()
    rows = spark.table(name).select(
        F.lit("table").alias("sink"), F.concat_ws(",", "PNO", F.col("PRETIME").cast("string")).alias("line")
    )
    for sink, path in (("topic", topic), ("file", file)):
        lines = spark.read.text(path).select(F.lit(sink).alias("sink"), F.col("value").alias("line"))
        rows = rows.unionByName(lines)
    return rows


class FailsOnce:
    """A sink that runs another one and then fails, the first time a batch has the number."""

    def __init__(self, sink, number: int = 1):
        self.sink, self.number, self.failed = sink, number, False

    def __call__(self, df, batch):
        self.sink(df, batch)
        if batch[1] == self.number and not self.failed:
            self.failed = True
            raise RuntimeError("this sink fails once")


def _until_done(start) -> None:
    """Run a stream that takes what is there; begin anew where a sink failed."""
    for _ in range(3):
        try:
            start().awaitTermination()
            return
        except StreamingQueryException as error:
            if "this sink fails once" not in str(error):
                raise
    raise RuntimeError("the stream failed again and again")


def _keyed_stream(spark, sf_dir, parts: int = 4) -> DataFrame:
    """Keyed records scored on a stream of several micro-batches, one file each."""
    source = scratch_path(spark, "keyed7")
    records = feeds.keyed7_records(_orders(spark, sf_dir))
    write_parquet(records.repartition(parts, "key"), source)
    return plans.score_keyed_stream(stream_parquet(spark, source, records.schema, max_files=1), BOOST3)


@query
def stream_ledger_delivery(spark, sf_dir):
    """Sinks that only append, one of which fails after its first write: the others have each line once."""
    scored, checkpoint = _keyed_stream(spark, sf_dir), scratch_path(spark, "stream-checkpoint")
    paths = [scratch_path(spark, label) for label in ("first", "failing", "last")]
    line = key_minutes_line(F.col("PNO"), F.col("minutes"))
    sinks = [text_sink(path, line, keyed=False) for path in paths]
    sinks[1] = FailsOnce(text_sink(paths[1], line))  # its own batch is replaced
    _until_done(lambda: start_fan_out(scored, sinks, checkpoint, interval=None, ledger=True))
    rows = None
    for name, path in zip(("first", "failing", "last"), paths):
        lines = spark.read.text(path).select(F.lit(name).alias("sink"), F.col("value").alias("line"))
        rows = lines if rows is None else rows.unionByName(lines)
    return rows


@query
def stream_messages_once(spark, sf_dir):
    """Messages with ids, some sent twice by a batch that ran again, read as a stream that takes each once."""
    scored, checkpoint = _keyed_stream(spark, sf_dir), scratch_path(spark, "stream-checkpoint")
    topic, target = scratch_path(spark, "topic"), scratch_path(spark, "messages")

    def send(df, batch):
        out = with_message_id(df, batch, ["PNO", "minutes"])
        message = minutes_message(F.col("PNO"), F.col("minutes")).alias("message")
        write_parquet(out.select("PNO", message, "message_id", F.current_timestamp().alias("sent")), topic)

    sinks = [FailsOnce(send)]
    _until_done(lambda: start_fan_out(scored, sinks, checkpoint, interval=None))
    sent = spark.read.parquet(topic)
    read = each_once(stream_parquet(spark, topic, sent.schema, max_files=25), "sent", "1 day").select("PNO", "message")
    start_files(read, "parquet", target, scratch_path(spark, "stream-checkpoint"), interval=None).awaitTermination()
    return spark.read.schema(read.schema).parquet(target)


@query
def first_delivery_rows(spark, sf_dir):
    """A batch delivered twice, its rows dealt out anew: equal rows of one delivery all stay, how many there are."""
    rows = _keyed_scored(spark, sf_dir).select("minutes")
    path = scratch_path(spark, "delivered")
    for parts in (3, 5):
        again = with_place(rows.repartition(parts))
        write_parquet(again.withColumns({"stream_id": F.lit("s"), "batch_id": F.lit(7)}), path)
    return first_delivery(spark.read.parquet(path)).groupBy("minutes").agg(F.count("*").alias("n_rows"))


@query
def stream_mape(spark, sf_dir):
    """The error of a scored stream, summed up on its way to a sink."""
    source, target = scratch_path(spark, "features"), scratch_path(spark, "scored")
    rows = feeds.features(_orders(spark, sf_dir)).withColumn("SECOND", 60 + F.col("k") % 3600).drop("o_orderdate", "o_totalprice")
    write_parquet(rows.repartition(4, "k"), source)
    name = f"error_{uuid.uuid4().hex}"
    stream = score_trees(stream_parquet(spark, source, rows.schema, max_files=1), FOREST4)
    seen = ObservedError(name)
    spark.streams.addListener(seen)
    try:
        observed = with_observed_error(stream, "SECOND", "prediction", name).select("PNO", "prediction")
        start_files(observed, "parquet", target, scratch_path(spark, "stream-checkpoint"), interval=None).awaitTermination()
        expected = spark.read.schema(observed.schema).parquet(target).count()
        for _ in range(300):  # progress is reported some time after a batch
            if sum(n for _, n in seen.batches.values()) >= expected:
                break
            time.sleep(0.1)
        else:
            raise TimeoutError("the stream's progress was not reported")
    finally:
        spark.streams.removeListener(seen)
    return spark.createDataFrame([(round(seen.mape(), 6), len(seen.batches) > 1)], "mape double, several_batches boolean")


@query
def stream_sql_batches(spark, sf_dir):
    """SQL over a view of each micro-batch; the sums of all batches."""
    scored, target = _keyed_stream(spark, sf_dir), scratch_path(spark, "sums")
    text = "select minutes, count(*) as n_rows, sum(seconds) as total from batch group by minutes"
    start_fan_out(
        scored, [sql_sink(text, parquet_sink(target))], scratch_path(spark, "stream-checkpoint"), interval=None).awaitTermination()
    sums = spark.read.parquet(target).groupBy("minutes")
    return sums.agg(F.sum("n_rows").alias("n_rows"), F.sum("total").alias("total"))


@query
def stream_dense_index(spark, sf_dir):
    """Numbers that go on from batch to batch, also over a batch that ran again."""
    scored, target = _keyed_stream(spark, sf_dir), scratch_path(spark, "numbered")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    sink = numbered(FailsOnce(parquet_sink(target)), ledger_folder(checkpoint), order_by="PNO")
    _until_done(lambda: start_fan_out(scored, [sink], checkpoint, interval=None))
    rows = spark.read.parquet(target)
    return rows.agg(
        F.count("*").alias("n_rows"), F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"),
        F.count_distinct("row_id").alias("n_ids"), F.count_distinct("PNO").alias("n_keys"))


@query
def stream_named_projection(spark, sf_dir):
    """The first two fields of a stream's records, by SQL over a view on the stream."""
    source = scratch_path(spark, "keyed7")
    records = feeds.keyed7_records(_orders(spark, sf_dir))
    write_parquet(records, source)
    view = f"input_{uuid.uuid4().hex}"
    register_view(plans.named_pairs(stream_parquet(spark, source, records.schema, max_bytes=REPLAY_BYTES)), view)
    pairs = spark.sql(f"select PNO, usetime from {view}")
    target, checkpoint = scratch_path(spark, "pairs"), scratch_path(spark, "stream-checkpoint")
    start_files(pairs, "parquet", target, checkpoint, interval=None).awaitTermination()
    rows = spark.read.schema(pairs.schema).parquet(target)
    return rows.select(F.col("PNO").cast("double").alias("PNO"), "usetime")


@query
def stream_events_parquet(spark, sf_dir):
    """Events as (key, value) bytes, the way a topic delivers them, to text pairs."""
    schema = table(spark, sf_dir, "events").schema
    events = stream_table(spark, f"{sf_dir}/events.parquet", schema, max_bytes=REPLAY_BYTES)
    value = F.concat_ws(",", F.col("event_id").cast("string"), "event_type", "props")
    records = events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"), F.encode(value, "UTF-8").alias("value")
    )
    pairs = keyed_text(records)
    target, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "stream-checkpoint")
    start_files(pairs, "parquet", target, checkpoint, interval=None).awaitTermination()
    return spark.read.schema(pairs.schema).parquet(target)


# Byte payloads


@query
def utf8_clean(spark, sf_dir):
    """Pages with bad bytes put before, inside and after; the text must come out whole."""
    half = F.floor(F.length("html") / 2).cast("int")
    text = F.col("html")
    left, right = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))
    bad = [F.unhex(F.lit(h)) for h in ("FF80", "E282", "C0")]
    value = F.concat(bad[0], F.encode(left, "UTF-8"), bad[1], F.encode(right, "UTF-8"), bad[2])
    records = table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), value.alias("value"))
    return plans.payload_text(records).withColumnRenamed("key", "page_id")


@query
def utf8_encode(spark, sf_dir):
    records = table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), F.col("html").alias("value"))
    return plans.payload_bytes(records).select(
        F.col("key").alias("page_id"),
        F.octet_length("bytes").cast("bigint").alias("size"),
        F.md5("bytes").alias("bytes_md5"),
    )


@query
def image_read(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    images = gather_image_tasks(read_images(spark, write_page_images(pages)), pages)
    return page_pixels(plans.image_pixels(images), page_of("origin"))


@query
def image_stream(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    images = gather_image_tasks(stream_images(spark, write_page_images(pages), max_bytes=REPLAY_BYTES), pages)
    pixels = page_pixels(plans.image_pixels(images), page_of("origin"))
    target, checkpoint = scratch_path(spark, "pixels"), scratch_path(spark, "stream-checkpoint")
    start_files(pixels, "parquet", target, checkpoint, interval=None).awaitTermination()
    return spark.read.schema(pixels.schema).parquet(target)


@query
def image_payload_stream(spark, sf_dir):
    """Images that arrive as bytes of a keyed record, decoded on the stream: gray ones of 8 and of 16
    bits, and ones with three channels."""
    source = scratch_path(spark, "payloads")
    records = page_payloads(table(spark, sf_dir, "pages"))
    write_parquet(records, source)
    stream = keyed_bytes(stream_parquet(spark, source, records.schema, max_bytes=REPLAY_BYTES))
    pixels = page_pixels(plans.decode_images(stream, decode_map), F.col("key"))
    target, checkpoint = scratch_path(spark, "pixels"), scratch_path(spark, "stream-checkpoint")
    start_files(pixels, "parquet", target, checkpoint, interval=None).awaitTermination()
    return spark.read.schema(pixels.schema).parquet(target)
