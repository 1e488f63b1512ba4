import json
import random

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

import linear_model
from linear_model import LinearModel
from scoreflow.catalog.feeds import BOOST3, BOOST_DUMP, BOOST_IMPORTED, FOREST4, large_forest
from scoreflow.layouts import MRI11
from scoreflow.models import TreeEnsemble, broadcast_model
from scoreflow.operators import (
    map_batches,
    mape,
    preview,
    python_scorer,
    register_view,
    run_sql,
    schema_report,
    score_mllib,
    score_python,
    score_trees,
    visit_partitions,
    with_minutes,
    with_seconds,
)

cloudpickle.register_pickle_by_value(linear_model)


def walk(tree, row, split):
    while "value" not in tree:
        x, t = row[tree["feature"]], tree["threshold"]
        tree = tree["yes"] if (x <= t if split == "le" else x < t) else tree["no"]
    return tree["value"]


def by_hand(model, row):
    values = [walk(t, row, model.split) for t in model.trees]
    total = sum(values)
    return (total / len(values) if model.combine == "mean" else total) + model.base


def random_tree(rnd, depth):
    if depth == 0 or rnd.random() < 0.15:
        return {"value": rnd.randint(-500, 3000)}
    return {"feature": rnd.choice(MRI11.columns), "threshold": rnd.randint(-5, 60),
            "yes": random_tree(rnd, depth - 1), "no": random_tree(rnd, depth - 1)}


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = [[rnd.randint(-10, 70) for _ in MRI11.columns] for _ in range(200)]
    return spark.createDataFrame(data, ", ".join(f"{c} bigint" for c in MRI11.columns)).repartition(3)


@pytest.mark.parametrize("combine,split,base", [("mean", "le", 0.0), ("sum", "lt", -7.5)])
def test_trees_agree_with_a_walk_by_hand(rows, combine, split, base):
    rnd = random.Random(11)
    for trees, depth in ((1, 0), (1, 1), (5, 3), (3, 5)):
        model = TreeEnsemble({"features": MRI11.columns, "combine": combine, "split": split, "base": base,
                              "trees": [random_tree(rnd, depth) for _ in range(trees)]})
        scored = rows.withColumn("column", model.to_column())
        scored = score_python(scored, model, MRI11.columns, "python")
        for row in scored.collect():
            expected = by_hand(model, row.asDict())
            assert row["column"] == pytest.approx(expected, abs=1e-9)
            assert row["python"] == pytest.approx(expected, abs=1e-9)


def test_the_caller_chooses_the_form(rows):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for model in (FOREST4, large_forest()):
        assert "ArrowEvalPython" not in plan(score_trees(rows.limit(1), FOREST4, form="column"))
        assert "ArrowEvalPython" in plan(score_trees(rows, model, form="arrow"))
    assert sorted(score_trees(rows, FOREST4, form="arrow").collect()) == sorted(score_trees(rows, FOREST4).collect())
    with pytest.raises(ValueError, match="form must be"):
        score_trees(rows, FOREST4, form="fast")


@pytest.mark.parametrize("form", ["column", "arrow"])
def test_both_forms_treat_inputs_alike(spark, form):
    tree = {"feature": "a", "threshold": 1, "yes": {"value": 1}, "no": {
        "feature": "b", "threshold": 0.5, "yes": {"value": 2}, "no": {"value": 4}}}
    model = TreeEnsemble({"features": ["a", "b"], "combine": "sum", "trees": [tree] * 80})
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 9.0), (2.0, 0.5), (2.0, 1.0), (None, 1.0), (2.0, None), (inf, -inf), (-inf, inf), (nan, nan)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, b double").coalesce(1)
    got = {r.i: r.prediction for r in score_trees(df, model, form=form).collect()}
    assert got == {0: 80.0, 1: 160.0, 2: 320.0, 3: None, 4: None, 5: 160.0, 6: 80.0, 7: 320.0}
    swapped = {r.i: r.prediction for r in score_trees(df, model, ["b", "a"], form=form).collect()}
    assert swapped[0] == 320.0 and swapped[1] == 80.0
    for wrong in (["a"], ["a", "b", "i"]):
        with pytest.raises(ValueError, match="takes 2 features"):
            score_trees(df, model, wrong, form=form)
    with pytest.raises(ValueError, match="takes 2 features"):
        model.predict(np.zeros((3, 3)))


def test_no_prediction_without_all_features(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, None)], "a bigint, b bigint")
    model = TreeEnsemble({"features": ["a", "b"], "trees": [
        {"feature": "a", "threshold": 1, "yes": {"value": 60}, "no": {"value": 120}}]})
    assert [r.prediction for r in score_trees(df, model).collect()] == [60.0, None, None]
    scored = score_python(df.coalesce(1), LinearModel([1, 10]), ["a", "b"])
    assert [r.prediction for r in scored.collect()] == [21.0, None, None]
    none_known = score_python(df.filter("a is null"), LinearModel([1, 10]), ["a", "b"])
    assert [r.prediction for r in none_known.collect()] == [None]


def test_columns_may_have_other_names(spark):
    df = spark.createDataFrame([(1, 9)], "`odd name` bigint, b bigint")
    model = TreeEnsemble({"features": ["x"], "trees": [
        {"feature": "x", "threshold": 1, "yes": {"value": 5}, "no": {"value": 6}}]})
    assert score_trees(df, model, ["odd name"]).first().prediction == 5.0
    with pytest.raises(ValueError, match="takes 1 features"):
        model.to_column(["odd name", "b"])


def test_model_file(spark, tmp_path):
    spec = {"features": ["a"], "combine": "sum", "base": 1, "trees": [{"value": 2}]}
    path = tmp_path / "model.json"
    path.write_text(json.dumps(spec, indent=2))
    model = TreeEnsemble.load(spark, str(path))
    assert model.predict(np.zeros((2, 1))).tolist() == [3.0, 3.0]
    for bad in ({"combine": "max"}, {"split": "gt"}, {"trees": []}):
        with pytest.raises(ValueError):
            TreeEnsemble({**spec, **bad})


def test_python_model_is_broadcast_once_and_size_checked(spark, rows):
    shared = broadcast_model(spark, LinearModel(np.ones(11)))
    scorer = python_scorer(shared)
    got = rows.select(scorer(*MRI11.columns).alias("p"), sum(F.col(c) for c in MRI11.columns).alias("s"))
    assert all(r.p == r.s for r in got.collect())
    assert score_python(rows, shared, MRI11.columns).count() == rows.count()
    with pytest.raises(ValueError, match="limit"):
        broadcast_model(spark, LinearModel(np.ones(1000)), max_bytes=100)
    with pytest.raises(TypeError, match="predict"):
        broadcast_model(spark, object())


def test_filter_goes_below_the_python_score(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).selectExpr("id AS a", "id % 7 AS b", "id AS unused").write.parquet(path)
    scored = score_python(spark.read.parquet(path), LinearModel([1, 1]), ["a", "b"])
    plan = scored.filter("a > 90").select("prediction")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,90)" in plan and "unused" not in plan


def test_mllib_by_model_and_by_path(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(10)], "a double, label double")
    steps = [VectorAssembler(inputCols=["a"], outputCol="features"), LinearRegression()]
    model = Pipeline(stages=steps).fit(df)
    path = str(tmp_path / "model")
    model.save(path)
    for given in (model, path):
        scored = score_mllib(df, given, name="p")
        assert scored.columns == ["a", "label", "p"]
        assert all(abs(r.p - r.label) < 1e-6 for r in scored.collect())


def test_seconds_and_minutes(spark):
    df = spark.createDataFrame([(119.99,), (-0.5,), (None,)], "prediction double")
    got = with_minutes(with_seconds(df)).select("seconds", "minutes").collect()
    assert [tuple(r) for r in got] == [(119, 1), (0, 0), (None, None)]


def test_mape_leaves_zero_labels_out(spark):
    df = spark.createDataFrame([(100, 90.0), (0, 5.0), (50, 60.0), (None, 1.0)], "y bigint, p double")
    assert mape(df, "y", "p").first().mape == pytest.approx(15.0)
    assert mape(df.filter("y = 0"), "y", "p").first().mape is None


def test_boosted_fixture_is_exact(spark):
    x = np.array([[1499, 0, 9, 0, 39, 0, 0], [1500, 45, 10, 1, 70, 6, 3]])
    assert BOOST3.predict(x).tolist() == [420.5 + 300 - 40 + 18, 420.5 + 95 - 275 - 9]


def test_batches_and_visitor(spark, tmp_path):
    df = spark.range(50).withColumn("x", F.lit("unused")).repartition(3)
    doubled = map_batches(df, lambda b: b.assign(twice=b["id"] * 2), "id bigint, twice bigint", ["id"])
    assert sorted(r.twice for r in doubled.collect()) == [2 * i for i in range(50)]

    folder = str(tmp_path)

    def visit(batches):
        import uuid

        count = sum(len(b) for b in batches)
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            out.write(str(count))

    visit_partitions(df, visit)
    counts = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(counts) == 50 and len(counts) == 3


def test_sql_preview_and_schema(spark):
    df = spark.createDataFrame([("P1", 30, 2, 5), ("P2", 20, 2, 6), ("P3", 31, 1, 7)],
                               "PNO string, AGE bigint, IO bigint, SECOND bigint")
    text = "select PNO, SECOND from people where AGE > :age and IO = 2"
    assert [tuple(r) for r in run_sql(text, {"people": df}, age=20).collect()] == [("P1", 5)]
    register_view(df, "people_again")
    assert spark.table("people_again").count() == 3
    assert [r.PNO for r in preview(df, 2, order_by=F.desc("AGE")).collect()] == ["P3", "P1"]
    assert preview(df, 1).count() == 1
    report = [tuple(r) for r in schema_report(df).collect()]
    assert report[0] == (0, "PNO", "string", True) and len(report) == 4


def test_scorer_in_sql(spark):
    spark.udf.register("linear_score", python_scorer(broadcast_model(spark, LinearModel([1, 10]))))
    df = spark.createDataFrame([(1, 2), (3, None)], "a bigint, b bigint")
    got = run_sql("select linear_score(a, b) as p from pairs_to_score order by a", {"pairs_to_score": df})
    assert [r.p for r in got.collect()] == [21.0, None]


def test_a_dumped_model_in_both_forms(spark):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        values = [rng.choice([None, float("nan"), float(rng.randint(0, 60))]) for _ in MRI11.columns]
        rows.append((i, *values))
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} double" for c in MRI11.columns)).coalesce(1)

    def walk_dump(node, row):
        while "leaf" not in node:
            value = row[node["split"]]
            if value is None or value != value:
                target = node["missing"]
            else:
                target = node["yes"] if np.float32(value) < np.float32(node["split_condition"]) else node["no"]
            node = next(c for c in node["children"] if c["nodeid"] == target)
        return np.float32(node["leaf"])

    for form in ("column", "arrow"):
        for row in score_trees(df, BOOST_IMPORTED, form=form).collect():
            total = np.float32(0.1)
            for tree in BOOST_DUMP:
                total = np.float32(total + walk_dump(tree, row.asDict()))
            assert row.prediction == float(total)
