"""Workers that cannot import the package: only the driver has it on its path."""

import os
import subprocess
import sys
import textwrap

from conftest import ROOT

SCRIPT = """
    import sys
    sys.path.insert(0, {root!r})
    from scoreflow.catalog.feeds import FOREST4
    from scoreflow.operators import map_batches, score_python
    from scoreflow.session import build_session

    class Own:
        def predict(self, x):
            return x.sum(axis=1)

    spark = build_session("bare", "local[2]", **{{"spark.ui.enabled": "false"}})
    df = spark.range(50).selectExpr(*[f"id + {{i}} AS {{c}}" for i, c in enumerate(FOREST4.features)])
    trees = score_python(df, FOREST4, FOREST4.features, "by_python").withColumn("by_column", FOREST4.to_column())
    assert trees.filter("by_python = by_column").count() == 50
    own = score_python(df, Own(), FOREST4.features)
    assert own.filter("prediction = 11 * AGE + 55").count() == 50
    model = FOREST4
    batches = map_batches(df, lambda b: b[[]].assign(p=model.predict(b.to_numpy())), "p double")
    assert batches.count() == 50
    print("all scored")
"""


def test_models_travel_by_value(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(textwrap.dedent(SCRIPT.format(root=ROOT)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all scored" in run.stdout, run.stderr[-3000:]
