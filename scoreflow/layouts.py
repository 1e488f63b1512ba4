"""Positional layouts of delimited feeds."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from scoreflow import fixed_values as fixed

# Type of a field's text, and the SQL type it becomes. A "truncated" field is
# written as a decimal and read as a whole number, so it must be finite.
FIELD_TYPES = {"bigint": "bigint", "double": "double", "string": "string", "truncated": "bigint"}


@dataclass(frozen=True)
class FieldLayout:
    """Names and types of the leading fields of a line; later fields are ignored."""

    name: str
    fields: tuple[tuple[str, str], ...]
    separator: str = ","

    def __post_init__(self):
        unknown = [t for _, t in self.fields if t not in FIELD_TYPES]
        if unknown:
            raise ValueError(f"layout {self.name}: field types must be in {list(FIELD_TYPES)}, got {unknown}")
        if len(set(self.columns)) != len(self.fields):
            raise ValueError(f"layout {self.name}: field names repeat")

    @classmethod
    def of(cls, name: str, columns: Iterable[str], type_: str, separator: str = ",") -> FieldLayout:
        return cls(name, tuple((c, type_) for c in columns), separator)

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in self.fields]

    def position(self, column: str) -> int:
        return self.columns.index(column)

    def truncated(self) -> FieldLayout:
        """The same fields with decimals read as whole numbers."""
        return FieldLayout(
            self.name,
            tuple((c, "truncated" if t == "double" else t) for c, t in self.fields),
            self.separator,
        )

    def rename(self, *columns: str) -> FieldLayout:
        """The same types under other names, for feeds whose fields carry no names."""
        if len(columns) != len(self.fields):
            raise ValueError(f"layout {self.name} has {len(self.fields)} fields, got {len(columns)} names")
        return FieldLayout(
            self.name, tuple((c, t) for c, (_, t) in zip(columns, self.fields)), self.separator
        )


MRI11 = FieldLayout.of("mri11", fixed.MRI11_FIELDS, "bigint")
KAFKA8 = FieldLayout.of("kafka8", [f"F{i}" for i in range(fixed.KAFKA8_SIZE)], "bigint")
KEYED7 = FieldLayout.of("keyed7", fixed.KEYED7_FIELDS, "double")
PEOPLE9 = FieldLayout(
    "people9", tuple((c, "string" if c == "PNO" else "bigint") for c in fixed.PEOPLE9_FIELDS)
)
PAIR = FieldLayout.of("pair", ("PNO", "usetime"), "string")

LAYOUTS = {layout.name: layout for layout in (MRI11, KAFKA8, KEYED7, PEOPLE9, PAIR)}
