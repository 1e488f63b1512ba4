"""Pieces of SQL text.

Wide projections are given to Spark as SQL text: one call into the JVM in place
of several per column, which for a plan of a few hundred expressions is the
difference between a second of driver time and none.
"""

from __future__ import annotations


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
