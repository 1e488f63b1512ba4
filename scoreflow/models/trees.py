"""Tree-ensemble regressors in a portable form.

A model is a JSON object:

    {"features": ["AGE", ...], "combine": "mean" | "sum", "base": 0.0,
     "split": "le" | "lt", "precision": "double" | "single", "trees": [node, ...]}

with nodes `{"feature": name, "threshold": t, "yes": node, "no": node}` or
`{"value": v}`. Averaged forests use "mean" and "le"; boosted trees use "sum",
a base score, and "le" or "lt" as their trainer does.

A split may say where missing values go, `"missing": "yes" | "no"`; a model with
such splits scores rows whatever is missing, others need all features. NaN counts
as missing there. With "single", values, thresholds and leaves are single-precision
and are summed so, tree by tree from the base on, as boosting trainers do. With
`"inputs": "single"` only the values are rounded to single precision, and compared
with thresholds in double precision, as trainers of averaged forests do.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, SparkSession, functions as F

from scoreflow.functions.sqltext import name


class TreeEnsemble:
    def __init__(self, spec: dict):
        self.features = list(spec["features"])
        self.combine = spec.get("combine", "mean")
        self.base = float(spec.get("base", 0.0))
        self.split = spec.get("split", "le")
        self.precision = spec.get("precision", "double")
        self.inputs = spec.get("inputs", self.precision)
        self.trees = spec["trees"]
        if self.combine not in ("mean", "sum") or self.split not in ("le", "lt"):
            raise ValueError("combine must be mean or sum, split must be le or lt")
        if self.precision not in ("double", "single"):
            raise ValueError("precision must be double or single")
        if self.inputs not in ("double", "single"):
            raise ValueError("inputs must be double or single")
        if not self.trees:
            raise ValueError("an ensemble needs at least one tree")
        self._tables = [_tables(t, self.features) for t in self.trees]
        self.accepts_missing = any(table["has_missing"] for table in self._tables)

    @classmethod
    def from_boosted_dump(cls, trees: str | list, features: Sequence[str], base: float = 0.5) -> TreeEnsemble:
        """A boosted model from its trainer's JSON dump: a list of trees whose splits have
        `split`, `split_condition`, `yes`, `no`, `missing` and `children`, whose leaves have `leaf`.

        Values below the condition go to `yes`; arithmetic is single-precision.
        """

        def node(dumped: dict) -> dict:
            if "leaf" in dumped:
                return {"value": dumped["leaf"]}
            children = {child["nodeid"]: child for child in dumped["children"]}
            return {
                "feature": dumped["split"],
                "threshold": dumped["split_condition"],
                "yes": node(children[dumped["yes"]]),
                "no": node(children[dumped["no"]]),
                "missing": "yes" if dumped.get("missing", dumped["no"]) == dumped["yes"] else "no",
            }

        dumped = json.loads(trees) if isinstance(trees, str) else trees
        return cls({"features": list(features), "combine": "sum", "base": base, "split": "lt",
                    "precision": "single", "trees": [node(tree) for tree in dumped]})

    @classmethod
    def from_node_arrays(
        cls, trees: Sequence[Mapping[str, Sequence]], features: Sequence[str], combine: str = "mean", base: float = 0.0
    ) -> TreeEnsemble:
        """A forest from flat arrays of nodes, one set for each tree, as forest trainers keep them:
        `children_left`, `children_right`, `feature`, `threshold` and `value`, all by node, the root first.

        A node without children (-1) is a leaf. Values up to the threshold go left; they are rounded to single
        precision before, thresholds stay in double precision. `value` has a number for each node, or nested lists
        of one. `missing_go_to_left`, if there, says where missing values go; without it rows need all features.
        Nodes that no path from the root reaches are ignored; a loop is refused.
        """

        def number(value) -> float:
            while hasattr(value, "__len__"):
                if len(value) != 1:
                    raise ValueError("a leaf has several values")
                value = value[0]
            return float(value)

        def tree(arrays: Mapping[str, Sequence]) -> dict:
            left, right = arrays["children_left"], arrays["children_right"]
            missing = arrays.get("missing_go_to_left")
            made: dict[int, dict] = {}
            seen, waiting = set(), [0]
            order = []
            while waiting:
                i = waiting.pop()
                if i in seen or not 0 <= i < len(left):
                    raise ValueError(f"node {i} has two parents or is not there")
                seen.add(i)
                order.append(i)
                if left[i] >= 0:
                    waiting += [int(left[i]), int(right[i])]
            for i in reversed(order):  # children before their parents
                if left[i] < 0:
                    made[i] = {"value": number(arrays["value"][i])}
                    continue
                made[i] = {
                    "feature": features[int(arrays["feature"][i])], "threshold": float(arrays["threshold"][i]),
                    "yes": made[int(left[i])], "no": made[int(right[i])]}
                if missing is not None:
                    made[i]["missing"] = "yes" if missing[i] else "no"
            return made[0]

        return cls({"features": list(features), "combine": combine, "base": base, "inputs": "single",
                    "trees": [tree(arrays) for arrays in trees]})

    @classmethod
    def from_json(cls, text: str) -> TreeEnsemble:
        return cls(json.loads(text))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeEnsemble:
        """Read a model file from any file system Spark reads."""
        files = spark.read.text(path, wholetext=True).limit(2).collect()
        if len(files) != 1:
            raise ValueError(f"a model is one file, {path} has {'none' if not files else 'several'}")
        return cls.from_json(files[0][0])

    @classmethod
    def from_mllib(cls, model, features: Sequence[str]) -> TreeEnsemble:
        """A fitted MLlib forest or boosted regressor with splits on ordered features."""

        def node(fitted) -> dict:
            if fitted.getClass().getSimpleName() == "LeafNode":
                return {"value": weight * fitted.prediction()}
            split = fitted.split()
            return {"feature": features[split.featureIndex()], "threshold": split.threshold(),
                    "yes": node(fitted.leftChild()), "no": node(fitted.rightChild())}

        boosted = "GBT" in type(model).__name__
        trees = []
        for tree, weight in zip(model.trees, model.treeWeights):
            weight = weight if boosted else weight * len(model.trees) / sum(model.treeWeights)
            trees.append(node(tree._call_java("rootNode")))
        return cls({"features": list(features), "combine": "sum" if boosted else "mean", "trees": trees})

    @property
    def splits(self) -> int:
        return sum(int((table["feature"] >= 0).sum()) for table in self._tables)

    def checked_columns(self, columns: Sequence[str] | None = None) -> list[str]:
        """The columns that feed the model, one for each feature in its order."""
        names = list(columns or self.features)
        if len(names) != len(self.features):
            raise ValueError(f"the model takes {len(self.features)} features, got {len(names)}")
        return names

    def to_column(self, columns: Sequence[str] | None = None) -> Column:
        """The model as nested CASE expressions over `columns`, in feature order.

        A row without all features has no prediction.
        """
        names = self.checked_columns(columns)
        inputs = {f: name(c) for f, c in zip(self.features, names)}

        def grow(node: dict) -> str:
            if "value" in node:
                return self.number_text(node["value"])
            value = self.input_text(inputs[node["feature"]])
            test = f"{value} {operator} {self.number_text(node['threshold'])}"
            if self.accepts_missing:
                absent = f"({value} IS NULL OR isnan({value}))"
                test = f"({absent} OR {test})" if node.get("missing") == "yes" else f"(NOT {absent} AND {test})"
            return f"CASE WHEN {test} THEN {grow(node['yes'])} ELSE {grow(node['no'])} END"

        operator = "<=" if self.split == "le" else "<"
        total = self.total_text([grow(tree) for tree in self.trees])
        known = " AND ".join(f"{column} IS NOT NULL" for column in inputs.values())
        return F.expr(total if self.accepts_missing else f"CASE WHEN {known} THEN {total} END")

    def number_text(self, value: float) -> str:
        """A threshold or leaf in SQL, in the model's precision."""
        single = self.precision == "single"
        return f"CAST({float(np.float32(value))!r}D AS FLOAT)" if single else f"{float(value)!r}D"

    def input_text(self, column: str) -> str:
        """A feature in SQL, as it is compared with thresholds."""
        if self.precision == "single":
            return f"CAST({column} AS FLOAT)"
        return f"CAST(CAST({column} AS FLOAT) AS DOUBLE)" if self.inputs == "single" else f"CAST({column} AS DOUBLE)"

    def total_text(self, trees: list[str]) -> str:
        """The prediction in SQL from the trees' values."""
        if self.precision == "single":
            summed = " + ".join([self.number_text(self.base), *trees] if self.combine == "sum" else trees)
            mean = f" / {self.number_text(len(trees))} + {self.number_text(self.base)}" if self.combine == "mean" else ""
            return f"CAST(({summed}){mean} AS DOUBLE)"
        total = "(" + " + ".join(trees) + ")"
        if self.combine == "mean":
            total = f"{total} / {len(self.trees)}D"
        return f"{total} + {self.base!r}D"

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for the rows of a 2-D array, one tree level at a time."""
        x = np.asarray(x, dtype=np.float64)
        if x.ndim != 2 or x.shape[1] != len(self.features):
            raise ValueError(f"the model takes {len(self.features)} features, got an array of shape {x.shape}")
        n = len(x)
        single = self.precision == "single"
        kind = np.float32 if single else np.float64
        if self.inputs == "single":
            x = x.astype(np.float32)
        cells = np.ascontiguousarray(x.T).ravel().astype(kind)  # one feature after the other
        rows = np.arange(n)
        total = np.full(n, self.base if single and self.combine == "sum" else 0, kind)
        compare = np.less_equal if self.split == "le" else np.less
        for table in self._tables:
            node = np.zeros(n, dtype=np.int64)
            for _ in range(table["depth"]):
                value = cells.take(table["column"].take(node) * n + rows)
                yes = compare(value, table["threshold"].astype(kind).take(node))
                if self.accepts_missing:
                    yes = np.where(np.isnan(value), table["missing"].take(node), yes)
                node = table["next"].take(2 * node + yes)
            total += table["value"].astype(kind).take(node)
        if self.combine == "mean":
            total = total / kind(len(self._tables))
        if not (single and self.combine == "sum"):
            total = total + kind(self.base)
        return total.astype(np.float64)


def _tables(tree: dict, features: list[str]) -> dict:
    """A tree as arrays indexed by node. `next` holds the "no" and "yes" successors of
    each node in turn; a leaf is its own successor."""
    feature, threshold, yes, no, value, missing = [], [], [], [], [], []
    has_missing = False

    def add(node: dict) -> tuple[int, int]:
        nonlocal has_missing
        i = len(feature)
        missing.append(node.get("missing") == "yes")
        has_missing = has_missing or "missing" in node
        leaf = "value" in node
        feature.append(-1 if leaf else features.index(node["feature"]))
        threshold.append(0.0 if leaf else float(node["threshold"]))
        value.append(float(node["value"]) if leaf else 0.0)
        yes.append(i)
        no.append(i)
        if leaf:
            return i, 0
        yes[i], left = add(node["yes"])
        no[i], right = add(node["no"])
        return i, 1 + max(left, right)

    _, depth = add(tree)
    feature = np.array(feature)
    return {
        "feature": feature,
        "column": np.maximum(feature, 0),
        "threshold": np.array(threshold),
        "next": np.column_stack([no, yes]).ravel(),
        "value": np.array(value),
        "depth": depth,
        "missing": np.array(missing),
        "has_missing": has_missing,
    }
