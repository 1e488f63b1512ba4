"""Masks and flat arrays of nodes against a walk down the trees, node by node."""

import random

import numpy as np
import pytest

from scoreflow.models import TreeEnsemble
from scoreflow.operators import score_trees


def grown(rng, depth, features, missing):
    if depth == 0 or rng.random() < 0.1:
        return {"value": rng.randint(-900, 900) / 8}
    node = {"feature": rng.choice(features), "threshold": rng.choice([0.1, 1.5, 3, 7.25, 16777217.0, rng.uniform(-9, 9)]),
            "yes": grown(rng, depth - 1, features, missing), "no": grown(rng, depth - 1, features, missing)}
    if missing:
        node["missing"] = rng.choice(["yes", "no"])
    return node


def walked(model, row):
    """The prediction for one row, by the rules of the format."""
    number = np.float32 if model.precision == "single" else np.float64

    def leaf(node):
        if "value" in node:
            return number(node["value"])
        value = row[node["feature"]]
        if value is None or (model.accepts_missing and np.isnan(value)):
            return leaf(node[node["missing"]])
        value = np.float32(value) if model.inputs == "single" else value
        value, threshold = (number(value), number(node["threshold"]))
        return leaf(node["yes"] if (value <= threshold if model.split == "le" else value < threshold) else node["no"])

    if not model.accepts_missing and any(v is None for v in row.values()):
        return None
    total = number(model.base) if model.combine == "sum" else number(0)
    for tree in model.trees:
        total = number(total + leaf(tree))
    return float(total if model.combine == "sum" else total / number(len(model.trees)) + number(model.base))


@pytest.mark.parametrize("case", range(6))
def test_all_forms_equal_the_walk(spark, case):
    rng = random.Random(case)
    features = ["a", "b", "odd name"]
    missing = case in (1, 4)
    model = TreeEnsemble({
        "features": features, "combine": ["sum", "mean"][case % 2], "base": 0.5 if case % 2 == 0 else 0.0,
        "split": ["le", "lt"][case // 2 % 2], "precision": "single" if case in (2, 4) else "double",
        "inputs": "single" if case == 5 else ("single" if case in (2, 4) else "double"),
        "trees": [grown(rng, depth, features, missing) for depth in (0, 1, 2, 3, 5, 8)],  # the last has over 64 leaves
    })
    values = [None, -1.0, 0.1, 1.5, 3.0, 7.25, 16777216.0, 16777217.0, 16777218.0, float("nan")]
    rows = [tuple(rng.choice(values) if rng.random() < 0.5 else rng.uniform(-9, 9) for _ in features) for _ in range(400)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a double, b double, `odd name` double")
    expected = [walked(model, dict(zip(features, r))) for r in rows]
    for form in ("masks", "column", "arrow"):
        got = {r["id"]: r["prediction"] for r in score_trees(df, model, form=form).collect()}
        assert [got[i] for i in range(len(rows))] == expected, form


def test_masks_keep_other_columns_and_need_no_python(spark):
    model = TreeEnsemble({"features": ["x"], "trees": [{"value": 2.0}, {"feature": "x", "threshold": 1, "yes": {"value": 0}, "no": {"value": 4}}]})
    df = spark.createDataFrame([(0, 1.0, "k"), (2, 9.0, "l"), (None, 9.0, "m")], "x int, prediction double, `a b` string")
    scored = score_trees(df, model, form="masks")
    assert sorted(scored.columns) == ["a b", "prediction", "x"]
    assert {(r["a b"], r["prediction"]) for r in scored.collect()} == {("k", 1.0), ("l", 3.0), ("m", None)}
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    only_leaf = TreeEnsemble({"features": ["x"], "trees": [{"value": 2.0}]})
    assert {r["prediction"] for r in score_trees(df, only_leaf, form="masks").collect()} == {2.0, None}


def test_flat_arrays(spark):
    arrays = {"children_left": [1, -1, 3, -1, -1], "children_right": [2, -1, 4, -1, -1], "feature": [0, -2, 1, -2, -2],
              "threshold": np.array([0.1, -2, 5, -2, -2]), "value": np.array([0, 1, 0, 2, 3.0]).reshape(-1, 1, 1)}
    model = TreeEnsemble.from_node_arrays([arrays], ["a", "b"])
    # 0.1 in single precision is above the threshold, which is in double precision.
    assert model.predict(np.array([[0.1, 5.0], [0.09, 0], [1, 6]])).tolist() == [2.0, 1.0, 3.0]
    lost = TreeEnsemble.from_node_arrays([{**arrays, "missing_go_to_left": [1, 0, 0, 0, 0]}], ["a", "b"])
    assert lost.accepts_missing and lost.predict(np.array([[np.nan, 1.0], [1, np.nan]])).tolist() == [1.0, 3.0]
    with pytest.raises(ValueError, match="two parents"):
        TreeEnsemble.from_node_arrays([{**arrays, "children_left": [1, -1, 0, -1, -1]}], ["a", "b"])
    with pytest.raises(ValueError, match="several values"):
        TreeEnsemble.from_node_arrays([{**arrays, "value": np.zeros((5, 1, 2))}], ["a", "b"])
