"""Tree ensembles as bit masks, for the JVM.

A leaf is a bit, a tree a field of bits in words of 63. The thresholds of each feature are sorted once, and a
value's bin is the number of thresholds that it does not pass. For each feature and bin a row of words says which
leaves are still open: each split that the value fails shuts the leaves of its yes side. The rows of all features
ANDed leave some leaves open in each tree, of which the lowest is the one that the record falls into.

So a prediction is one binary search for each feature and a few ANDs for each word, however deep the trees, and not
a CASE for each split. Words are columns of their own. Spark makes one method of a stage, which the JIT leaves
alone if it is large; but a projection with a lambda or with over a hundred columns is divided into small methods.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame

from scoreflow.functions.sqltext import name as name_of

#: The sign bit stays clear, so that no word's arithmetic overflows.
WORD_BITS = 63
_PREFIX = "_mask_"


def _leaves(node: dict) -> list[float]:
    """Leaf values from the yes side to the no side."""
    return [node["value"]] if "value" in node else [*_leaves(node["yes"]), *_leaves(node["no"])]


def _splits(node: dict, first: int = 0):
    """(feature, threshold, missing, first and last leaf of the yes side) of each split."""
    if "value" in node:
        return
    yes = len(_leaves(node["yes"]))
    yield node["feature"], node["threshold"], node.get("missing", "no"), first, first + yes
    yield from _splits(node["yes"], first)
    yield from _splits(node["no"], first + yes)


class TreeMasks:
    """The words, bins and leaf tables of a TreeEnsemble."""

    def __init__(self, model):
        self.model = model
        self.single = model.precision == "single"
        number = np.float32 if self.single else np.float64
        self.leaves = [_leaves(tree) for tree in model.trees]
        if not all(math.isfinite(v) for values in self.leaves for v in values):
            raise ValueError("a leaf is not a finite number")
        # Each tree's first bit; a tree lies in one word if it fits one.
        self.begins, bit = [], 0
        for values in self.leaves:
            if bit % WORD_BITS + len(values) > WORD_BITS:
                bit = -(-bit // WORD_BITS) * WORD_BITS
            self.begins.append(bit)
            bit += len(values)
        self.words = -(-bit // WORD_BITS)
        found: dict[str, list[tuple]] = {f: [] for f in model.features}
        for tree, begin in zip(model.trees, self.begins):
            for feature, threshold, missing, first, last in _splits(tree):
                found[feature].append((float(number(threshold)), missing, begin + first, begin + last))
        self.thresholds = {f: sorted({s[0] for s in splits}) for f, splits in found.items()}
        self.rows = {f: self._rows(splits, self.thresholds[f]) for f, splits in found.items() if splits}

    def _rows(self, splits: list[tuple], thresholds: list[float]) -> list[list[int]]:
        """Open leaves for each bin, and last for a missing value."""
        place = {t: i for i, t in enumerate(thresholds)}
        open_bits = np.ones((len(thresholds) + 2, self.words * WORD_BITS), bool)
        for threshold, missing, first, last in splits:
            open_bits[place[threshold] + 1 : -1, first:last] = False
            if missing != "yes":
                open_bits[-1, first:last] = False
        words = np.zeros((len(open_bits), self.words, 64), bool)
        words[:, :, :WORD_BITS] = open_bits.reshape(len(open_bits), self.words, WORD_BITS)
        return np.packbits(words, axis=2, bitorder="little").view("<i8")[:, :, 0].tolist()

    def _bin(self, value: str, thresholds: list[float], passes: str) -> str:
        """The number of thresholds that the value does not pass, by binary search."""

        def search(low: int, high: int) -> str:
            if low == high:
                return str(low)
            middle = (low + high) // 2
            test = f"{value} {passes} {self.model.number_text(thresholds[middle])}"
            return f"CASE WHEN {test} THEN {search(low, middle)} ELSE {search(middle + 1, high)} END"

        found = search(0, len(thresholds))
        if self.model.accepts_missing:
            found = f"CASE WHEN {value} IS NULL OR isnan({value}) THEN {len(thresholds) + 1} ELSE {found} END"
        return found

    def _leaf(self, tree: int) -> str:
        """The value of the lowest open leaf of a tree."""
        values, begin = self.leaves[tree], self.begins[tree]
        if len(values) == 1:
            return self.model.number_text(values[0])
        kind = "float" if self.single else "double"
        table = json.dumps([float(np.float32(v)) if self.single else float(v) for v in values])
        first, last = begin // WORD_BITS, (begin + len(values) - 1) // WORD_BITS
        # The bits under the lowest one that is set are as many as its place.
        def place(word: int, shift: int) -> str:
            bits = f"shiftrightunsigned({_PREFIX}w{word}, {shift})" if shift else f"{_PREFIX}w{word}"
            return f"bit_count(({bits} & (~{bits} + 1L)) - 1L)"

        at = place(last, begin % WORD_BITS if first == last else 0)
        if first != last:  # a tree of several words begins at the first bit of one
            cases = " ".join(f"WHEN {_PREFIX}w{w} <> 0 THEN {(w - first) * WORD_BITS} + {place(w, 0)}" for w in range(first, last))
            at = f"CASE {cases} ELSE {(last - first) * WORD_BITS} + {at} END"
        return f"get(from_json('{table}', 'array<{kind}>'), {at})"

    def score(self, df: DataFrame, columns: list[str], name: str) -> DataFrame:
        kept = [name_of(c) for c in df.columns if c != name]
        inputs = {f: name_of(c) for f, c in zip(self.model.features, columns)}
        used = [f for f in self.model.features if f in self.rows]
        passes = "<=" if self.model.split == "le" else "<"
        rows = []
        for i, feature in enumerate(used):
            value = self.model.input_text(inputs[feature])
            at = self._bin(value, self.thresholds[feature], passes)
            table = json.dumps(self.rows[feature], separators=(",", ":"))
            rows.append(f"get(from_json('{table}', 'array<array<bigint>>'), {at}) AS {_PREFIX}r{i}")
        # A lambda is not put into a stage's method, nor what is projected beside it: rows are looked up in small
        # methods too.
        test = "true" if self.model.accepts_missing else "x IS NOT NULL"
        values = ", ".join(f"CAST({column} AS DOUBLE)" for column in inputs.values())
        masked = df.selectExpr("*", f"forall(array({values}), x -> {test}) AS {_PREFIX}known", *rows)
        words = [
            " & ".join(f"{_PREFIX}r{i}[{w}]" for i in range(len(used))) + f" AS {_PREFIX}w{w}"
            for w in range(self.words if used else 0)
        ]
        opened = masked.selectExpr(*(name_of(c) for c in df.columns), f"{_PREFIX}known", *words)
        total = self.model.total_text([self._leaf(t) for t in range(len(self.leaves))])
        return opened.selectExpr(*kept, f"CASE WHEN {_PREFIX}known THEN {total} END AS {name_of(name)}")
