"""Sentences and lines rendered from scored rows, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scoreflow import fixed_values as fixed


def _fill(template: str, *values: Column) -> Column:
    return F.format_string(template.replace("{}", "%s"), *values)


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(fixed.MISSING_KEY))


def minutes_message(key: Column, minutes: Column) -> Column:
    return _fill(fixed.MINUTES_MESSAGE, key_text(key), minutes)


def seconds_message(seconds: Column) -> Column:
    return _fill(fixed.SECONDS_MESSAGE, seconds)


def seconds_line(seconds: Column) -> Column:
    """The text sink ends the line."""
    return _fill(fixed.SECONDS_LINE, seconds)


def key_minutes_line(key: Column, minutes: Column) -> Column:
    return _fill(fixed.KEY_MINUTES_LINE, key_text(key), minutes)


def result_time(stamp: Column) -> Column:
    return F.date_format(stamp, fixed.RESULT_TIME_FORMAT)
