import json

import pytest

from scoreflow.cli import main
from scoreflow.sources import read_lines

GOOD = "54,1,9,12,33,2,2,7,1,4,18"


@pytest.fixture
def model(tmp_path):
    path = tmp_path / "model.json"
    path.write_text(json.dumps({"features": [f"f{i}" for i in range(11)], "trees": [
        {"feature": "f0", "threshold": 50, "yes": {"value": 90}, "no": {"value": 150.5}}]}))
    return str(path)


@pytest.fixture
def keyed_model(tmp_path):
    path = tmp_path / "keyed.json"
    path.write_text(json.dumps({"features": [f"f{i}" for i in range(7)], "combine": "sum", "base": 1, "trees": [
        {"feature": "f0", "threshold": 12, "yes": {"value": 120}, "no": {"value": 60}}]}))
    return str(path)


def test_batch(spark, tmp_path, model, capsys):
    source = tmp_path / "lines.txt"
    source.write_text(f"{GOOD}\n40,1\n50,1,9,12,33,2,2,7,1,4,N/A\n50{GOOD[2:]}\n")
    out = str(tmp_path / "out")
    main(["batch-score", "--input", str(source), "--model", model, "--output", out], spark)
    assert [r.value for r in read_lines(spark, out).collect()] == ["150.5", "90.0"]
    indexed = str(tmp_path / "indexed")
    main(["batch-score", "--input", str(source), "--model", model, "--indexed", "--policy", "drop",
          "--output", indexed], spark)
    assert sorted(r.value for r in read_lines(spark, indexed).collect()) == ["(0, 150.5)", "(1, 90.0)"]
    main(["batch-score", "--input", str(source), "--model", model, "--rows", "1"], spark)
    assert "prediction" in capsys.readouterr().out


def test_line_stream(spark, tmp_path, model, capsys):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text(f"{GOOD}\nbad\n")
    main(["line-stream", "--folder", str(folder), "--model", model, "--checked", "10", "--interval", "once",
          "--checkpoint", str(tmp_path / "c"), "--file", str(tmp_path / "out"), "--console"], spark)
    got = spark.read.text(str(tmp_path / "out")).select("value").collect()
    assert [r.value for r in got] == ["This patient need 150.5 seconds to detect from MRI"]
    assert "150.5" in capsys.readouterr().out


def test_keyed_stream(spark, tmp_path, keyed_model):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("P1\t12.9,33,7,1,54,4,2\nP2\t13,33,7,1,54,4,2\n14,33,7,1,54,4,2\n")
    main(["keyed-stream", "--folder", str(folder), "--model", keyed_model, "--interval", "once",
          "--checkpoint", str(tmp_path / "c"), "--file", str(tmp_path / "out"), "--append",
          "--result-table", "cli_result"], spark)
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == ["None,1", "P1,2", "P2,1"]
    assert spark.table("cli_result").columns == ["PNO", "PRETIME", "Time"]
    assert spark.table("cli_result").count() == 3


def test_model_loader(spark, tmp_path):
    source = tmp_path / "lines.txt"
    source.write_text(GOOD + "\n")
    out = str(tmp_path / "out")
    main(["batch-score", "--input", str(source), "--model", "2", "--model-loader", "test_cli:load_model",
          "--output", out], spark)
    assert read_lines(spark, out).first().value == str(2.0 * sum(map(int, GOOD.split(","))))


def load_model(argument):
    from pyspark import cloudpickle

    import linear_model

    cloudpickle.register_pickle_by_value(linear_model)
    return linear_model.LinearModel([float(argument)] * 11)


def test_people(spark, tmp_path, capsys):
    source = tmp_path / "people.txt"
    source.write_text("P17,12,33,7,1,54,4,2,1260\nP18,12,33,7,1,19,4,2,1261\n")
    main(["people-sql", "--input", str(source), "--csv-output", f"{tmp_path}/csv",
          "--parquet-output", f"{tmp_path}/parquet"], spark)
    shown = capsys.readouterr().out
    assert "P17" in shown and "P18" not in shown and "SECOND: long" in shown
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 2


def test_images(spark, tmp_path):
    from test_sources_sinks import png

    folder = tmp_path / "images"
    folder.mkdir()
    (folder / "a.png").write_bytes(png(2, 1, bytes(6)))
    main(["payload-stream", "--images", str(folder), "--interval", "once", "--checkpoint", str(tmp_path / "c")], spark)
