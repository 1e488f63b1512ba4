"""Byte payloads to text and back, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_REPLACEMENT = "\uFFFD"
_MARK = "\uE000"


def clean_utf8(payload: Column) -> Column:
    """Text of a byte column with invalid UTF-8 bytes left out.

    `make_valid_utf8` turns bad bytes into U+FFFD. A U+FFFD that the payload
    really holds is written as mark + "b" before and restored after; a mark in
    the payload is written as mark + "a" for the same reason.
    """

    def swap(text: Column, old: str, new: str) -> Column:
        return F.replace(text, F.lit(old), F.lit(new))

    text = swap(payload.cast("string"), _MARK, _MARK + "a")
    text = swap(text, _REPLACEMENT, _MARK + "b")
    text = swap(F.make_valid_utf8(text), _REPLACEMENT, "")
    text = swap(text, _MARK + "b", _REPLACEMENT)
    return swap(text, _MARK + "a", _MARK)


def encode_utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")
