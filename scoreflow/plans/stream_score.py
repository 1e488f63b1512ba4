"""Streaming jobs: lines or keyed records to predictions, on frames of any source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scoreflow.functions import minutes_message
from scoreflow.layouts import KEYED7, MRI11, PAIR, FieldLayout
from scoreflow.operators import parse_delimited, parse_with_rejects, project_pair, with_minutes, with_seconds
from scoreflow.plans.batch_score import score
from scoreflow.sinks import Sink, kafka_sink


def score_stream(
    lines: DataFrame,
    model,
    layout: FieldLayout = MRI11,
    policy: str = "strict",
    checked: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse and score the `value` column; `checked` drops lines as in the batch job."""
    return score(parse_delimited(lines, layout, policy, checked, keep=keep), model, layout.columns)


def score_keyed_stream(
    records: DataFrame,
    model,
    layout: FieldLayout = KEYED7,
    policy: str = "strict",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(`key`, `value`) records to (`PNO`, `prediction`, `seconds`, `minutes`).

    Features arrive as decimals and are truncated to whole numbers. What is no
    finite number falls under `policy`.
    """
    rows = parse_delimited(records, layout.truncated(), policy, keep=["key", *keep])
    scored = score(rows, model, layout.columns)
    result = with_minutes(with_seconds(scored))
    return result.select(F.col("key").alias("PNO"), *keep, "prediction", "seconds", "minutes")


def score_keyed_with_rejects(
    records: DataFrame, model, layout: FieldLayout = KEYED7, keep: Sequence[str] = ()
) -> DataFrame:
    """`score_keyed_stream` for every record, with `line` and `reason`: rejected ones are there too,
    for a sink of their own, so that no record stops the stream or goes without trace."""
    rows = parse_with_rejects(records, layout.truncated(), keep=["key", *keep])
    scored = with_minutes(with_seconds(score(rows, model, layout.columns)))
    return scored.select(F.col("key").alias("PNO"), *keep, "prediction", "seconds", "minutes", "line", "reason")


def named_pairs(records: DataFrame, layout: FieldLayout = PAIR) -> DataFrame:
    """The first two fields of each record as (`PNO`, `usetime`)."""
    return records.select("value").transform(project_pair, layout)


def publish_minutes(servers: str, topic: str, identified: bool = False) -> Sink:
    """Sink that sends the sentence on each scored row to a topic; `identified` gives each message its id as a header."""
    over = ["PNO", "minutes"] if identified else None
    return kafka_sink(servers, topic, minutes_message(F.col("PNO"), F.col("minutes")), over=over)
