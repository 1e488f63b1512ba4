"""Filters and positional parsing of delimited lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scoreflow.fixed_values import CHECKED_FIELD
from scoreflow.functions.numbers import float_text_sql, int_text_sql, lettered_sql
from scoreflow.functions.sqltext import literal, name
from scoreflow.layouts import FIELD_TYPES, FieldLayout

POLICIES = ("strict", "drop", "null")
SHORT_ROWS = ("drop", "fail")

_READERS = {
    "bigint": int_text_sql,
    "double": lambda text: float_text_sql(text, "_lettered"),
    "string": lambda text: text,
    "truncated": lambda text: f"try_cast({float_text_sql(text, '_lettered')} AS bigint)",
}


def drop_blank(df: DataFrame, value: str = "value") -> DataFrame:
    return df.filter(F.col(value) != "")


def split_fields(df: DataFrame, value: str = "value", separator: str = ",", into: str = "fields") -> DataFrame:
    """Add the array of the line's fields; empty fields are kept."""
    return df.withColumn(into, F.expr(_split(value, separator)))


def keep_int_field(
    df: DataFrame,
    position: int = CHECKED_FIELD,
    short_rows: str = "drop",
    value: str = "value",
    separator: str = ",",
) -> DataFrame:
    """Keep lines whose field at `position` is a whole number.

    `short_rows` says what a line without that field does: leave the feed
    ("drop") or fail the job ("fail").
    """
    _one_of("short_rows", short_rows, SHORT_ROWS)
    kept = f"CASE WHEN {_is_int(position)} THEN array(true) END"
    if short_rows == "fail":
        fail = _fail(f"line has no field {position}: ", "array<boolean>")
        kept = f"CASE WHEN size(_parts) <= {position} THEN {fail} ELSE {kept} END"
    parts = df.selectExpr("*", f"{name(value)} AS _line", f"{_split(value, separator)} AS _parts")
    # One element or none per row; see parse_delimited on why this is no filter.
    kept_rows = parts.selectExpr(*map(name, df.columns), f"explode({kept}) AS _kept")
    return kept_rows.drop("_kept")


def parse_delimited(
    df: DataFrame,
    layout: FieldLayout,
    policy: str = "strict",
    checked: int | None = None,
    short_rows: str = "drop",
    keep: Sequence[str] = (),
    value: str = "value",
) -> DataFrame:
    """Lines to named, typed columns, after the columns in `keep`.

    `policy` says what an unreadable or missing field does: fail the job
    ("strict"), remove the row ("drop") or become NULL ("null"). `checked` puts
    `keep_int_field` on that field first, within the same pass.

    A filter over parsed columns would be pushed below the projection, which
    repeats the split once per field. Rows are therefore kept or dropped by a
    generator that yields one record or none, so that each line is split and
    cast once, inside one code-generated stage.
    """
    _one_of("policy", policy, POLICIES)
    _one_of("short_rows", short_rows, SHORT_ROWS)
    kept = [name(c) for c in keep]
    parts = _parts(df, layout, kept, value)
    fields = _fields(layout)
    if policy == "null" and checked is None:
        return parts.selectExpr(*kept, *fields)

    record_type = "struct<" + ",".join(f"{name(c)}:{FIELD_TYPES[t]}" for c, t in layout.fields) + ">"
    rows = "array(_record)"
    if policy != "null":
        whole = " AND ".join(f"_record.{name(c)} IS NOT NULL" for c in layout.columns)
        rows = f"CASE WHEN {whole} THEN {rows}"
        if policy == "strict":
            rows += f" ELSE {_fail(f'line does not fit layout {layout.name}: ', f'array<{record_type}>')}"
        rows += " END"
    if checked is not None:
        rows = f"CASE WHEN _checked THEN {rows} END"
        if short_rows == "fail":
            fail = _fail(f"line has no field {checked}: ", f"array<{record_type}>")
            rows = f"CASE WHEN _size <= {checked} THEN {fail} ELSE {rows} END"
    records = parts.selectExpr(
        *kept,
        "_line",
        "size(_parts) AS _size",
        f"{'true' if checked is None else _is_int(checked)} AS _checked",
        f"struct({', '.join(fields)}) AS _record",
    )
    return records.selectExpr(*kept, f"inline({rows})")


def parse_with_rejects(
    df: DataFrame, layout: FieldLayout, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Every line, parsed or rejected: the columns in `keep`, `line`, `reason`, then the layout's columns.

    `reason` is NULL for a line that fits. Else it is "short" for a line with too few
    fields, or "field NAME" for the first one that cannot be read; the columns of such
    a line are NULL where they cannot be read. Rows in and out are equal in number, so
    nothing vanishes and no line stops a stream.
    """
    kept = [name(c) for c in keep]
    records = _parts(df, layout, kept, value).selectExpr(
        *kept, "_line AS line", "size(_parts) AS _size", f"struct({', '.join(_fields(layout))}) AS _record"
    )
    unread = " ".join(f"WHEN _record.{name(c)} IS NULL THEN {literal(f'field {c}')}" for c in layout.columns)
    reason = f"CASE WHEN _size < {len(layout.columns)} OR line IS NULL THEN 'short' {unread} END"
    columns = ", ".join(f"_record.{name(c)} AS {name(c)}" for c in layout.columns)
    # One element per row; a filter on the reason cannot be pushed below this, see parse_delimited.
    return records.selectExpr(*kept, "line", f"inline(array(struct({reason} AS reason, {columns})))")


def _parts(df: DataFrame, layout: FieldLayout, kept: Sequence[str], value: str) -> DataFrame:
    return df.selectExpr(
        *kept,
        f"{name(value)} AS _line",
        f"{_split(value, layout.separator)} AS _parts",
        f"{lettered_sql(name(value))} AS _lettered",
    )


def _fields(layout: FieldLayout) -> list[str]:
    return [
        f"{_READERS[type_](f'get(_parts, {i})')} AS {name(column)}"
        for i, (column, type_) in enumerate(layout.fields)
    ]


def project_pair(df: DataFrame, layout: FieldLayout, value: str = "value") -> DataFrame:
    """The first fields of a line as text columns, nothing checked."""
    return parse_delimited(df, layout, policy="null", value=value)


def cast_columns(df: DataFrame, columns: Sequence[str], to: str = "bigint") -> DataFrame:
    """Cast the named columns; what does not fit becomes NULL."""
    return df.selectExpr(*[
        f"try_cast({name(c)} AS {to}) AS {name(c)}" if c in columns else name(c) for c in df.columns
    ])


def _split(value: str, separator: str) -> str:
    # split() takes a pattern; \Q..\E keeps separators such as | literal.
    pattern = literal(separator if separator == "," else rf"\Q{separator}\E")
    return f"split({name(value)}, {pattern}, -1)"


def _is_int(position: int) -> str:
    return f"{int_text_sql(f'get(_parts, {position})')} IS NOT NULL"


def _fail(message: str, as_type: str) -> str:
    return f"CAST(raise_error(concat({literal(message)}, _line)) AS {as_type})"


def _one_of(what: str, given: str, allowed: Sequence[str]) -> None:
    if given not in allowed:
        raise ValueError(f"{what} must be one of {allowed}, got {given!r}")
