from scoreflow.functions.messages import (
    key_minutes_line,
    key_text,
    minutes_message,
    result_time,
    seconds_line,
    seconds_message,
)
from scoreflow.functions.numbers import float_text, int_text, truncate, whole_minutes
from scoreflow.functions.payloads import clean_utf8, encode_utf8
from scoreflow.functions.vectors import int_vector, truncate_vector, zip_rows

__all__ = [
    "clean_utf8", "encode_utf8", "float_text", "int_text", "int_vector", "key_minutes_line",
    "key_text", "minutes_message", "result_time", "seconds_line", "seconds_message", "truncate",
    "truncate_vector", "whole_minutes", "zip_rows",
]
