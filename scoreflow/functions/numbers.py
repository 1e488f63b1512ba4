"""Text-to-number rules and unit conversion.

The `_sql` forms take and give SQL text, for use in wide projections.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scoreflow.functions.sqltext import name

# Spellings accepted besides what a plain cast takes, and the ones it takes too much.
_GROUPED_INT = r"^\s*[+-]?\d+(?:_\d+)+\s*$"
_FLOAT = (
    r"^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)"
    r"(?:[eE][+-]?\d+(?:_\d+)*)?|(?i:inf|infinity|nan))\s*$"
)


def int_text_sql(text: str) -> str:
    """Whole number in `text` as bigint, or NULL.

    Surrounding space, a sign and `_` between digits are allowed; fractions and
    exponents are not. The second cast runs only where the first gives NULL.
    """
    return (
        f"coalesce(try_cast({text} AS bigint), "
        f"if({text} RLIKE r'{_GROUPED_INT}', try_cast(replace({text}, '_', '') AS bigint), NULL))"
    )


def float_text_sql(text: str, lettered: str | None = None) -> str:
    """Decimal number in `text` as double, or NULL; rejects `5d`, `5f` and hexadecimal.

    Only texts with a letter or `_`, such as exponents, need the full check.
    `lettered` is SQL that tells so for several texts at once.
    """
    checked = f"if({text} RLIKE r'{_FLOAT}', try_cast(replace({text}, '_', '') AS double), NULL)"
    return f"if({lettered or lettered_sql(text)}, {checked}, try_cast({text} AS double))"


def lettered_sql(text: str) -> str:
    return f"{text} RLIKE '[a-zA-Z_]'"


def int_text(column: str) -> Column:
    return F.expr(int_text_sql(name(column)))


def float_text(column: str) -> Column:
    return F.expr(float_text_sql(name(column)))


def truncate(number: Column) -> Column:
    """Drop the fraction, toward zero; NaN, infinite and oversized values give NULL."""
    return number.try_cast("bigint")


def whole_minutes(prediction: Column) -> Column:
    """Seconds truncated to a whole number, then floored to minutes."""
    return F.floor(truncate(prediction) / F.lit(60))
