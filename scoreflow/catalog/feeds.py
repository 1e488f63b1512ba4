"""Feeds in the layouts of the jobs, derived from the `orders` and `pages` tables.

Every row of a table becomes a record. Some records are damaged on purpose: when
the order key divides by 101 only five fields are there, else when it divides by
97 the last field is no number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from scoreflow.layouts import MRI11
from scoreflow.models import TreeEnsemble
from scoreflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def features(orders: DataFrame) -> DataFrame:
    """`k`, `PNO` and the eleven features, as numbers."""
    return orders.selectExpr(
        "o_orderkey AS k",
        "concat('P', o_orderkey) AS PNO",
        "o_orderkey % 100 AS AGE",
        "o_custkey % 4 AS TURN",
        "o_orderkey % 24 AS bhour",
        "o_orderkey * 7 % 50 AS ITEM_n",
        "o_custkey % 60 AS ORDERDR_n",
        "o_custkey % 5 AS MODEL_NAME_n",
        "1 + o_orderkey % 3 AS IO_n",
        "o_custkey % 30 AS DEPT_n",
        "o_orderkey % 2 AS SEX_n",
        "o_orderkey * 3 % 11 AS POS_n",
        "o_custkey % 40 AS MD_NO_n",
        "o_totalprice",
        "o_orderdate",
    )


def _joined(columns: Sequence[str], *more: str) -> str:
    return f"concat_ws(',', {', '.join([f'string({c})' for c in columns] + list(more))})"


def mri11_lines(orders: DataFrame) -> DataFrame:
    """(`k`, `PNO`, `value`), damaged records included."""
    names = MRI11.columns
    line = f"""CASE WHEN k % 101 = 0 THEN {_joined(names[:5])}
        WHEN k % 97 = 0 THEN {_joined(names[:10], "'N/A'")}
        ELSE {_joined(names)} END AS value"""
    return features(orders).selectExpr("k", "PNO", line)


def kafka8_records(orders: DataFrame) -> DataFrame:
    """(`key`, `value`) with the first eight features."""
    return features(orders).selectExpr("PNO AS key", f"{_joined(MRI11.columns[:8])} AS value")


def keyed7_records(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(`key`, `value`) with seven decimals; the first has a real fraction."""
    fields = ["o_totalprice / 100", "ORDERDR_n", "DEPT_n", "SEX_n", "AGE", "POS_n", "IO_n"]
    return features(orders).selectExpr("PNO AS key", f"{_joined(fields)} AS value", *keep)


def people_table(orders: DataFrame) -> DataFrame:
    return features(orders).selectExpr(
        "PNO", "ITEM_n AS Item", "ORDERDR_n AS ORDERDR", "DEPT_n AS DEPT", "SEX_n AS SEX",
        "AGE", "POS_n AS POS", "IO_n AS IO", "60 + k % 3600 AS SECOND",
    )


def people_lines(orders: DataFrame) -> DataFrame:
    people = people_table(orders)
    return people.selectExpr(f"{_joined(people.columns)} AS value")


def write_lines(lines: DataFrame, label: str) -> str:
    """Write (`value`) lines as text files and return their folder."""
    path = scratch_path(lines.sparkSession, label)
    lines.select("value").write.text(path)
    return path


# Small models over the feeds. Leaves are whole seconds, so that means of four
# and sums are exact in every engine.

def _split(feature: str, threshold: float, yes, no) -> dict:
    def node(x):
        return x if isinstance(x, dict) else {"value": x}

    return {"feature": feature, "threshold": threshold, "yes": node(yes), "no": node(no)}


FOREST4 = TreeEnsemble({
    "features": MRI11.columns,
    "combine": "mean",
    "trees": [
        _split("AGE", 50, _split("ITEM_n", 24, 600, 1207), _split("IO_n", 1, -90, 1501)),
        _split("DEPT_n", 14, _split("SEX_n", 0, 318, 905), _split("POS_n", 5, 1402, -31)),
        _split("ORDERDR_n", 30, _split("bhour", 11, 122, -2003), _split("TURN", 1, 777, 1810)),
        _split("MODEL_NAME_n", 2, _split("MD_NO_n", 19, -457, 250), _split("AGE", 25, 63, 999)),
    ],
})

def _grown(tree: int, node: int, depth: int) -> dict:
    """Node `node` (the root is 1, children 2n and 2n+1) of a full tree, by a rule that SQL can follow."""
    if depth == 0:
        return {"value": (tree * 31 + node * 97) % 2001 - 500}
    return {
        "feature": MRI11.columns[(tree * 7 + node * 3) % len(MRI11.columns)],
        "threshold": (tree * 13 + node * 17) % 50,
        "yes": _grown(tree, 2 * node, depth - 1),
        "no": _grown(tree, 2 * node + 1, depth - 1),
    }


LARGE_TREES, LARGE_DEPTH = 200, 5


def large_forest() -> TreeEnsemble:
    """200 trees with 6,200 splits; leaves are whole numbers, so sums are exact."""
    trees = [_grown(tree, 1, LARGE_DEPTH) for tree in range(LARGE_TREES)]
    return TreeEnsemble({"features": MRI11.columns, "combine": "sum", "trees": trees})


def _dumped(node: int, split: str, condition: float, missing: str, yes, no) -> dict:
    """A split as boosting trainers dump it; its children have the next two numbers of their level."""
    children = [
        {**child, "nodeid": 2 * node + i} if isinstance(child, dict) else {"nodeid": 2 * node + i, "leaf": child}
        for i, child in ((1, yes), (2, no))
    ]
    return {"nodeid": node, "split": split, "split_condition": condition, "yes": 2 * node + 1, "no": 2 * node + 2,
            "missing": 2 * node + (1 if missing == "yes" else 2), "children": children}


# Leaves are no binary fractions, and sums lie near whole minutes, so precision and order matter.
BOOST_DUMP = [
    _dumped(0, "AGE", 49.5, "no", _dumped(1, "MD_NO_n", 20.1, "yes", 59.6, 119.7), _dumped(2, "IO_n", 1.5, "no", 0.1, 179.9)),
    _dumped(0, "ITEM_n", 24.3, "yes", _dumped(1, "DEPT_n", 14.7, "yes", 0.1, 60.05), _dumped(2, "SEX_n", 0.5, "yes", 0.2, -0.4)),
    _dumped(0, "MD_NO_n", 30.2, "no", _dumped(1, "POS_n", 5.5, "no", 0.2, 0.3), _dumped(2, "bhour", 11.9, "no", 0.05, 119.95)),
]
BOOST_IMPORTED = TreeEnsemble.from_boosted_dump(BOOST_DUMP, MRI11.columns, base=0.1)

BOOST3 = TreeEnsemble({
    "features": ["Item", "ORDERDR", "DEPT", "SEX", "AGE", "POS", "IO"],
    "combine": "sum",
    "base": 420.5,
    "split": "lt",
    "trees": [
        _split("Item", 1500, _split("AGE", 40, 300, -611), _split("IO", 3, 1207, 95)),
        _split("DEPT", 10, _split("SEX", 1, -40, 233), _split("POS", 6, 610, -275)),
        _split("ORDERDR", 45, _split("AGE", 70, 18, 144), _split("Item", 3000, -9, 75)),
    ],
})

BOOST8 = TreeEnsemble({
    "features": [f"F{i}" for i in range(8)],
    "combine": "sum",
    "base": 500.0,
    "trees": [
        _split("F0", 30, _split("F3", 20, 120, 240), _split("F6", 2, -75, 410)),
        _split("F7", 12, _split("F1", 0, 33, -66), _split("F5", 3, 150, -20)),
    ],
})


def edge_features(orders: DataFrame) -> DataFrame:
    """`PNO`, `price` and `far`: values that single precision rounds, up and down and to even."""
    return orders.selectExpr(
        "concat('P', o_orderkey) AS PNO", "o_totalprice AS price", "CAST(16777208 + o_orderkey % 16 AS DOUBLE) + 0.25 * (o_custkey % 4) AS far")


# Flat arrays of nodes, as forest trainers keep them. Thresholds lie at the edges of single precision: 16777217
# is no single-precision number, so values there go the way of the number that they are rounded to.
NODE_ARRAYS = [
    {"children_left": [1, 3, -1, -1, -1], "children_right": [2, 4, -1, -1, -1], "feature": [1, 0, -2, -2, -2],
     "threshold": [16777217.0, 150000.015625, -2.0, -2.0, -2.0], "value": [[[0.0]], [[0.0]], [[480.5]], [[120.25]], [[-61.0]]]},
    {"children_left": [1, -1, 3, -1, -1], "children_right": [2, -1, 4, -1, -1], "feature": [1, -2, 1, -2, -2],
     "threshold": [16777215.99, -2.0, 16777218.5, -2.0, -2.0], "value": [[[0.0]], [[30.0]], [[0.0]], [[90.75]], [[1207.5]]]},
]
FLAT_FOREST = TreeEnsemble.from_node_arrays(NODE_ARRAYS, ["price", "far"])
